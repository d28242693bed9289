"""SQL for the text queries that SQL can express."""

from __future__ import annotations

from tillstar.llm.spans import SENTENCE, WORD
from tillstar.llm.tables import UPPER

_LOWER = f"translate({{}}, '{UPPER}', '{UPPER.lower()}')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES: dict[str, str] = {
    "op2_chat_formatting": rf"""
        WITH rows AS (
          SELECT conv_id, turn, role, text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
          UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), turns AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows
        ), sized AS (
          SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
            + len(regexp_extract_all(text, '</?s>|\[/?(?:SYS|INST|TEXT)\]|\[ROLE\]')) AS written,
            CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
              ELSE 19 + length(role) END AS around,
            lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
            lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS next
          FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
            AS turns_sha256,
          coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
            FILTER (role = 'assistant'), '')) AS loss_sha256,
          sum(written + around)::BIGINT AS formatted_chars,
          bool_and(CASE role
            WHEN 'system' THEN before IS NULL AND next IS NOT NULL
            WHEN 'user' THEN (before IS NULL OR before IN ('system', 'assistant'))
              AND next IS NOT NULL
            WHEN 'assistant' THEN before IS NOT NULL AND before = 'user'
            ELSE false END) AS is_valid
        FROM sized GROUP BY conv_id
    """,
    "op3_line_dedup": f"""
        WITH lines AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
          FROM documents
        ), keyed AS (
          SELECT *, {_LOWER.format(f"trim(line, {_SPACE})")} AS key FROM lines
        ), frequent AS (
          SELECT key FROM keyed WHERE length(key) >= 1
          GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        ), judged AS (
          SELECT k.*, f.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN frequent f ON k.key = f.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), ''))
            AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op4_decontamination": f"""
        WITH item_words AS (
          SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
        ), windows AS (
          SELECT DISTINCT item_id, least(len(w), 10) AS size,
            array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
          FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
                FROM item_words WHERE len(w) > 0)
        ), doc_words AS (
          SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), doc_windows AS (
          SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
                FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
        ), hits AS (
          SELECT d.doc_id, d.i, d.size, b.item_id
          FROM doc_windows d JOIN windows b ON d.size = b.size AND d.win = b.win
        ), hit_words AS (
          SELECT doc_id, count(DISTINCT pos) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY doc_id
        ), hit_items AS (
          SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
        )
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
          coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
          coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc_words d LEFT JOIN hit_words h ON d.doc_id = h.doc_id
        LEFT JOIN hit_items i ON d.doc_id = i.doc_id
    """,
    "op10_sentence_spans": f"""
        WITH sentences AS (
          SELECT doc_id, unnest(p) AS sentence, generate_subscripts(p, 1) AS no
          FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SENTENCE}') AS p
                FROM documents)
        ), words AS (
          SELECT doc_id, no, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS place
          FROM (SELECT *, regexp_extract_all(sentence, '{WORD}') AS w FROM sentences)
        ), ends AS (
          SELECT *, {_LOWER.format("trim(word, ' ' || chr(9) || chr(10) || chr(13))")} AS key FROM words
        ), parts AS (
          SELECT *, coalesce(sum((n > 12 AND (unicode(key) + length(key)) % 6 = 0)::INT) OVER (
            PARTITION BY doc_id, no ORDER BY place
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM ends
        ), keyed AS (
          SELECT doc_id, string_agg(word, '' ORDER BY place) AS piece,
            row_number() OVER (PARTITION BY doc_id ORDER BY no, part) AS pos,
            count(*) OVER (PARTITION BY doc_id) AS pieces,
            trim(regexp_replace({_LOWER.format("string_agg(word, '' ORDER BY place)")},
              '[ \t\r\n]+', ' ', 'g')) AS key
          FROM parts GROUP BY doc_id, no, part
        ), spans AS (
          SELECT doc_id, pos, pieces, concat_ws(chr(10), key, lead(key, 1) OVER w, lead(key, 2) OVER w)
            AS span
          FROM keyed WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
        ), later AS (
          SELECT doc_id, pos FROM (
            SELECT doc_id, pos, row_number() OVER (
              PARTITION BY span, least(pieces, 3) ORDER BY doc_id, pos) AS n
            FROM spans WHERE pos <= greatest(pieces - 2, 1)) WHERE n > 1
        ), covered AS (
          SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM later
        ), marked AS (
          SELECT k.doc_id, k.pos, k.piece, c.pos IS NOT NULL AS removed
          FROM keyed k LEFT JOIN covered c ON k.doc_id = c.doc_id AND k.pos = c.pos
        ), joined AS (
          SELECT doc_id, count(*) AS n_sentences, count(*) FILTER (removed) AS n_removed,
            coalesce(string_agg(piece, '' ORDER BY pos) FILTER (NOT removed), '') AS kept
          FROM marked GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n_sentences, 0) AS n_sentences,
          coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN joined j ON d.doc_id = j.doc_id
    """,
}

def _url_sql(order: int = 4) -> str:
    """SQL of the URL filter: gram counts, estimates for each context length, scores, threshold."""
    models = ("allow_fit", "block_fit", "allow_all", "block_all")
    sums = ", ".join(f"sum({m})::BIGINT AS {m}" for m in models)
    totals = ", ".join(
        f"sum({m})::DOUBLE AS {m}_n, count(*) FILTER ({m} > 0)::DOUBLE AS {m}_kinds" for m in models
    )
    levels = []
    for k in range(order + 1):
        estimates = ", ".join(
            f"CASE WHEN c.{m}_n > 0 THEN (g.{m}::DOUBLE + c.{m}_kinds * {{0}}) / (c.{m}_n + c.{m}_kinds) "
            f"ELSE {{0}} END AS p_{m}".format(f"s.p_{m}" if k else "(1.0::DOUBLE / 256)") for m in models
        )
        shorter = f"JOIN level{k - 1} s ON right(g.gram, {k}) = s.gram" if k else ""
        levels.append(f"""
        grams{k} AS (
          SELECT right(gram, {k + 1}) AS gram, {sums} FROM counts GROUP BY 1
        ), contexts{k} AS (
          SELECT left(gram, {k}) AS context, {totals} FROM grams{k} GROUP BY 1
        ), level{k} AS MATERIALIZED (
          SELECT g.gram, {estimates}
          FROM grams{k} g JOIN contexts{k} c ON left(g.gram, {k}) = c.context {shorter}
        )""")
    return f"""
        WITH split AS (
          SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS mark FROM pages
        ), rest AS (
          SELECT *, CASE WHEN mark > 0 THEN substr(u, mark + 3) ELSE '' END AS rest FROM split
        ), hosts AS (
          SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM rest
        ), parts AS (
          SELECT *, {_LOWER.format("raw_host")} AS host,
            regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM hosts
        ), rules(verdict, rhost, rpath) AS (
          VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                 ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
        ), fits AS (
          SELECT page_id, u, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
            arg_max(verdict, length(rhost || rpath)) AS label
          FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost))
            AND starts_with(path, rpath)
          GROUP BY page_id, u
        ), judged AS (
          SELECT p.page_id, p.host, p.path, f.rule, f.label,
            CASE WHEN mark > 0 THEN host || substr(rest, length(raw_host) + 1) ELSE p.u END AS address
          FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND p.u = f.u
        ), addresses AS (
          SELECT DISTINCT address, label, ('0x' || left(md5(address), 8))::BIGINT % 5 = 0 AS held
          FROM judged
        ), positions AS (
          SELECT address, label, held,
            substr(repeat(chr(2), {order}) || address || chr(3), i::BIGINT, {order + 1}) AS gram
          FROM (SELECT *, unnest(range(1, length(address) + 2)) AS i FROM addresses)
        ), counts AS MATERIALIZED (
          SELECT gram,
            count(*) FILTER (label = 'allow' AND NOT held) AS allow_fit,
            count(*) FILTER (label = 'block' AND NOT held) AS block_fit,
            count(*) FILTER (label = 'allow') AS allow_all,
            count(*) FILTER (label = 'block') AS block_all
          FROM positions GROUP BY gram
        ), {",".join(levels)}, ratios AS (
          SELECT gram, round((ln(p_allow_fit) - ln(p_block_fit)) * 1000000)::BIGINT AS fit,
            round((ln(p_allow_all) - ln(p_block_all)) * 1000000)::BIGINT AS whole FROM level{order}
        ), scores AS (
          SELECT address, label, greatest(-20000, least(20000, floor(
            sum(CASE WHEN label IS NULL THEN whole ELSE fit END)::DOUBLE / (count(*) * 1000)
          )))::BIGINT AS score
          FROM positions JOIN ratios USING (gram) WHERE label IS NULL OR held
          GROUP BY address, label
        ), bins AS (
          SELECT score, count(*) FILTER (label = 'allow') AS a, count(*) FILTER (label = 'block') AS b
          FROM scores WHERE label IS NOT NULL GROUP BY score
        ), errors AS (
          SELECT score, sum(a) OVER () AS total_a, sum(b) OVER () AS total_b,
            coalesce(sum(a) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING), 0) - a AS missed,
            coalesce(sum(b) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING), 0) - b AS caught
          FROM bins
        ), threshold AS (
          SELECT coalesce((SELECT score FROM errors WHERE total_a > 0 AND total_b > 0
            ORDER BY missed * total_b + (total_b - caught) * total_a, abs(score), score LIMIT 1), 0) AS t
        ), taught AS (
          SELECT bool_or(label = 'allow') AND bool_or(label = 'block') AS teaches FROM judged
        )
        SELECT page_id, host, path, rule, CASE WHEN rule IS NULL AND teaches THEN score END AS score,
          CASE WHEN rule IS NOT NULL THEN j.label WHEN NOT coalesce(teaches, false) THEN 'allow'
            WHEN score >= t THEN 'allow' ELSE 'block' END AS verdict
        FROM judged j CROSS JOIN threshold CROSS JOIN taught
        LEFT JOIN scores s ON j.address = s.address AND s.label IS NULL
    """


ORACLES["op11_fill_in_middle"] = """
    WITH units AS (
      SELECT doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
        sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
    ), dice AS (
      SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1,
        ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
        ('0x' || h[17:24])::BIGINT % 100 AS d3, ('0x' || h[25:32])::BIGINT % 100 AS d4 FROM units
    ), cut AS (
      SELECT doc_id, t, n,
        array_to_string(u[1 : least(c1, c2)], '') AS p,
        array_to_string(u[least(c1, c2) + 1 : greatest(c1, c2)], '') AS m,
        array_to_string(u[greatest(c1, c2) + 1 : n], '') AS s,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR d3 >= 90
          THEN 'plain' WHEN d4 < 20 THEN 'spm' ELSE 'psm' END AS form
      FROM dice
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
      sha256(t) AS restored_sha256
    FROM cut
"""

ORACLES["op12_filter_audit"] = f"""
    WITH texts AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents
    ), verdicts AS (
      SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
      FROM labels GROUP BY doc_id
    ), failing AS (
      SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * (length(t) - length(translate(t, '{UPPER}', ''))) > 10 * length(t)
             THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN first < texts.doc_id THEN 'E' ELSE '' END AS fails
      FROM texts LEFT JOIN verdicts v ON texts.doc_id = v.doc_id
    ), grouped AS (
      SELECT part, fails, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic
      FROM failing GROUP BY part, fails
    ), letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
    ), orders AS (
      SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
      FROM letters a, letters b, letters c, letters d, letters e
      WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
    ), steps AS (
      SELECT filter_order, step::INT AS step, filter_order[step:step] AS f,
        filter_order[1 : step - 1] AS before
      FROM (SELECT *, unnest(range(1, 6)) AS step FROM orders)
    ), met AS (
      SELECT part, filter_order, step, f, fails, docs, good, toxic, contains(fails, f) AS bad,
        translate(fails, before, '') <> fails AS gone
      FROM grouped, steps
    ), sums AS (
      SELECT part, filter_order, step, f,
        coalesce(sum(docs) FILTER (NOT gone AND NOT bad), 0)::BIGINT AS kept,
        coalesce(sum(docs) FILTER (NOT gone AND bad), 0)::BIGINT AS removed,
        coalesce(sum(docs) FILTER (gone AND bad), 0)::BIGINT AS redundant,
        coalesce(sum(docs) FILTER (fails = f), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (NOT gone AND bad), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (NOT gone AND bad), 0)::BIGINT AS toxic_lost
      FROM met GROUP BY part, filter_order, step, f
    )
    SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM sums
"""

ORACLES["op13_url_filters"] = _url_sql()
