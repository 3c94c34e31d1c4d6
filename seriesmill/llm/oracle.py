"""SQL for the queries that have a SQL form."""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE: dict[str, str] = {
    "op11_filter_interaction": r"""
        WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        worded AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM texts),
        judged AS (
            SELECT doc_id, part,
                len(ws) < 50 AS fa,
                100 * len(list_distinct(ws)) < 65 * len(ws) AS fb,
                100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS fc,
                regexp_matches(t, '[#$%&*|]') AS fd,
                coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS fe
            FROM worded),
        marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        counted AS (
            SELECT part, fa, fb, fc, fd, fe, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
            FROM judged LEFT JOIN marks USING (doc_id) GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
        orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS o
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f),
        steps AS (SELECT o, s, substr(o, s, 1) AS f FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
        removed AS (
            SELECT *, least(
                CASE WHEN fa THEN instr(o, 'A') ELSE 9 END, CASE WHEN fb THEN instr(o, 'B') ELSE 9 END,
                CASE WHEN fc THEN instr(o, 'C') ELSE 9 END, CASE WHEN fd THEN instr(o, 'D') ELSE 9 END,
                CASE WHEN fe THEN instr(o, 'E') ELSE 9 END) AS r
            FROM counted, orders),
        audited AS (
            SELECT part, s.o AS filter_order, s.s AS step, s.f,
                sum(CASE WHEN r > s.s THEN n ELSE 0 END) AS kept,
                sum(CASE WHEN r = s.s THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN r < s.s AND CASE s.f WHEN 'A' THEN fa WHEN 'B' THEN fb WHEN 'C' THEN fc WHEN 'D' THEN fd ELSE fe END THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN fa = (s.f = 'A') AND fb = (s.f = 'B') AND fc = (s.f = 'C') AND fd = (s.f = 'D') AND fe = (s.f = 'E') THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN r = s.s THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN r = s.s THEN toxic ELSE 0 END) AS toxic_lost
            FROM removed JOIN steps s ON removed.o = s.o GROUP BY part, s.o, s.s, s.f)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
            CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
            CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
        FROM audited""",
    "op12_source_divergence": rf"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
            FROM documents),
        tokens AS (SELECT r, lang, source, unnest(ws) AS term FROM texts),
        kept AS (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
        sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        occurring AS (SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY ALL),
        totals AS (SELECT lang, source, sum(n) AS total FROM occurring GROUP BY ALL),
        groups AS (
            SELECT g.lang, g.source, coalesce(total, 0) AS total, coalesce(v, 0) AS v
            FROM (SELECT DISTINCT lang, source FROM texts) g LEFT JOIN totals t ON g.lang = t.lang AND g.source = t.source LEFT JOIN sizes s ON g.lang = s.lang),
        shares AS (
            SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 2) // (total + 2 * v) AS p
            FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN occurring o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
        overall AS (
            SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (sum(n) + 2) // (max(all_n) + 2 * max(v)) AS q
            FROM (SELECT o.*, v, sum(n) OVER (PARTITION BY lang) AS all_n FROM occurring o JOIN sizes USING (lang)) GROUP BY lang, term),
        apart AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
                LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
        terms AS (
            SELECT s.lang, s.source, s.term AS item, (p - q) * (p - q) // (p + q) AS value
            FROM shares s JOIN overall o ON s.lang = o.lang AND s.term = o.term WHERE n > 0 AND p > q),
        ranked AS (
            SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS place FROM pairs
            UNION ALL
            SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR place <= 10""",
}
