"""SQL for DuckDB that gives the rows of the queries SQL can express."""

from meterflow.llm import chat, mixing

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'"
_SPACED = r"'[^\x{20}\x{09}-\x{0D}]+'"


def _words(pattern: str) -> str:
    return f"regexp_extract_all({_LOWER.format(chr(34) + 'text' + chr(34))}, {pattern})"


def _divided(name: str, parent: str, nodes: str) -> str:
    """CTEs that divide the budget `given` of each parent among its children (cap, weight)."""
    keys = parent.replace("1", "one")
    return f"""
        {name}_a AS (
            SELECT *, given - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
                   sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
            FROM ({nodes}) WINDOW o AS (PARTITION BY {keys} ORDER BY cap / weight, {name})),
        {name}_b AS (SELECT *, left_ * weight >= cap * weights AS full_ FROM {name}_a),
        {name}_c AS (
            SELECT *, max(CASE WHEN NOT full_ THEN left_ END) OVER (PARTITION BY {keys}) AS of_,
                   max(CASE WHEN NOT full_ THEN weights END) OVER (PARTITION BY {keys}) AS by_ FROM {name}_b),
        {name}_d AS (SELECT * EXCLUDE (given), CASE WHEN full_ THEN cap ELSE of_ * weight // by_ END AS given
                     FROM {name}_c)"""


def _mixing() -> str:
    domain = "CASE " + " ".join(
        f"WHEN source IN ({', '.join(repr(f'src{i}') for i in numbers)}) THEN '{name}'"
        for name, numbers in mixing.DOMAINS.items()) + " ELSE 'other' END"
    weights = ", ".join(f"('{k}', {v})" for k, v in mixing.WEIGHTS.items())
    epochs = mixing.MAX_EPOCHS
    return f"""
        WITH w(path, weight) AS (VALUES {weights}),
        d AS (SELECT doc_id, "text", lang AS lang0, source AS source0, {domain} AS domain,
                     coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     len(coalesce(regexp_extract_all("text", {_SPACED}), [])) AS n_tokens FROM documents
              WHERE n_tokens > 0),
        leaves AS (SELECT domain, lang, source, sum(n_tokens)::bigint AS supply, 1 AS one FROM d GROUP BY ALL),
        {_divided("domain", "1", f"""
            SELECT *, coalesce((SELECT weight FROM w WHERE path = domain), 1) AS weight,
                   (SELECT sum(supply)::bigint * {mixing.PERCENT} // 100 FROM leaves) AS given
            FROM (SELECT one, domain, sum(supply)::bigint * {epochs} AS cap FROM leaves GROUP BY ALL)""")},
        {_divided("lang", "domain", f"""
            SELECT x.*, coalesce((SELECT weight FROM w WHERE path = x.domain || '/' || x.lang), 1) AS weight, given
            FROM (SELECT domain, lang, sum(supply)::bigint * {epochs} AS cap FROM leaves GROUP BY ALL) x
            JOIN domain_d USING (domain)""")},
        {_divided("source", "domain, lang", f"""
            SELECT x.*, 1 AS weight, given
            FROM (SELECT domain, lang, source, supply, supply * {epochs} AS cap FROM leaves) x
            JOIN lang_d USING (domain, lang)""")},
        plan AS (SELECT domain, lang, source, given // supply AS epochs, given % supply AS rest
                 FROM source_d),
        o AS (SELECT *, md5('{mixing.SEED}:' || cast(epochs::int AS varchar) || ':' || coalesce(cast(doc_id AS varchar), '')) AS k
              FROM d JOIN plan USING (domain, lang, source)),
        p AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k, n_tokens, "text"
                                            ROWS UNBOUNDED PRECEDING) AS upto FROM o)
        SELECT * FROM (
            SELECT doc_id, domain, lang0 AS lang, source0 AS source, n_tokens,
                   (epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::int AS copies FROM p)
        WHERE copies > 0"""


def _escaped(name: str) -> str:
    out = rf"replace({name}, '\', '\\')"
    for control in chat.CONTROL:
        out = rf"replace({out}, '{control}', '{control[0]}\{control[1:]}')"
    return out


ORACLES = {
    "op1_decontaminate": f"""
        WITH d AS (SELECT doc_id, coalesce({_words(_ALNUM)}, []) AS w FROM documents),
        b AS (SELECT DISTINCT coalesce(cast(item_id AS varchar), '') AS item_id, {_words(_ALNUM)} AS w
              FROM benchmark),
        windows AS (
            SELECT item_id, 13 AS n, array_to_string(w[i:i + 12], ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM b WHERE len(w) >= 13)
            UNION SELECT item_id, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND 12),
        grams AS (
            SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i
                  FROM d CROSS JOIN (SELECT DISTINCT n FROM windows))),
        found AS (SELECT doc_id, n, i, item_id FROM grams JOIN windows USING (n, g)),
        hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                 FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
                  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op3_mixing": _mixing(),
    "op7_ngram_jaccard": f"""
        WITH RECURSIVE d AS (SELECT doc_id, coalesce({_words(_SPACED)}, []) AS w FROM documents),
        s AS MATERIALIZED (
            SELECT DISTINCT doc_id, g FROM (
                SELECT doc_id, array_to_string(w[i:i + 2], ' ') AS g
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
                UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 2)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS MATERIALIZED (
            SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same
                              FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
            JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
            WHERE 100 * same >= 90 * (p.n + q.n - same)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM d
                  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(b) AS component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY 1, 2""",
    "op8_line_dedup": f"""
        WITH l AS (
            SELECT doc_id, generate_subscripts(s, 1) AS i, unnest(s) AS line
            FROM (SELECT doc_id, string_split(coalesce("text", ''), chr(10)) AS s FROM documents)),
        k AS (SELECT doc_id, i, line,
                     {_LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key
              FROM l),
        firsts AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
                   GROUP BY key HAVING count(DISTINCT doc_id) > 1),
        m AS (SELECT doc_id, i, line, first IS NOT NULL AND first <> doc_id AS gone
              FROM k LEFT JOIN firsts USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op11_spelling": rf"""
        WITH RECURSIVE crc AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
                CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
        counted AS (
            SELECT doc_id, run, count(*) AS c FROM (
                SELECT doc_id, unnest(regexp_extract_all({_LOWER.format(chr(34) + 'text' + chr(34))},
                                                         '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents)
            WHERE length(run) >= 6 GROUP BY ALL),
        bytes AS (
            SELECT run, c, flatten(list_transform(string_split(coalesce(cast(doc_id AS varchar), '') || ':' || run, ''),
                lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END)) AS b FROM counted),
        summed AS (
            SELECT run, c, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, b::bigint[]),
                lambda y, x: xor(y // 256, t[xor(y, x) % 256 + 1]))) AS h FROM bytes, crc),
        v AS MATERIALIZED (
            SELECT word, sum(c)::bigint AS n FROM (
                SELECT c, CASE WHEN h % 199 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word
                FROM summed)
            WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
        skipped AS MATERIALIZED (
            SELECT word, n, i, word[1:i] AS a, word[i + 2:] AS z
            FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM v)),
        near AS MATERIALIZED (
            SELECT DISTINCT * FROM (
                SELECT x.word, y.word AS other, y.n AS other_n FROM skipped x JOIN skipped y USING (a, z) WHERE x.word <> y.word
                UNION ALL SELECT x.word, v.word, v.n FROM skipped x JOIN v ON x.a || x.z = v.word
                UNION ALL SELECT v.word, x.word, x.n FROM skipped x JOIN v ON x.a || x.z = v.word)),
        best AS (
            SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, (-other_n, other)) AS best
            FROM near GROUP BY word),
        f AS MATERIALIZED (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * v.n THEN best END AS form,
                   CASE WHEN best_n >= 5 * v.n THEN best_n END AS form_n
            FROM v LEFT JOIN best USING (word)),
        walk AS (
            SELECT word, word AS top, 0 AS steps FROM f
            UNION ALL SELECT walk.word, f.form, steps + 1 FROM walk JOIN f ON walk.top = f.word WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, root, f.n, f.n_near, f.form_n
        FROM f JOIN (SELECT word, arg_max(top, steps) AS root FROM walk GROUP BY word) USING (word)""",
    "op12_chat_format": f"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS t FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
               coalesce(sum(length(t)) FILTER (WHERE role = 'assistant'), 0)::bigint AS loss_chars,
               sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role, t) FILTER (WHERE role = 'assistant'), ''))
                   AS loss_sha256,
               sum(length({_escaped("role")}) + length({_escaped("t")}) + {len(chat.TURN + chat.TEXT + chat.END)})::bigint
                   AS formatted_chars
        FROM r GROUP BY conv_id""",
    "op13_fill_middle": """
        WITH w AS (
            SELECT doc_id, coalesce("text", '') AS t, sha256('1:' || coalesce(cast(doc_id AS varchar), '')) AS k,
                   coalesce(regexp_extract_all("text", '[A-Za-z]+|[^A-Za-z]'), []) AS u
            FROM documents),
        h AS (
            SELECT *, len(u)::bigint AS n, ('0x' || k[1:8])::bigint AS h1, ('0x' || k[9:16])::bigint AS h2,
                   ('0x' || k[17:24])::bigint AS h3, ('0x' || k[25:32])::bigint AS h4
            FROM w),
        c AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                        THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM h),
        p AS (
            SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
                   array_to_string(u[b + 1:n], '') AS suffix
            FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p""",
}
