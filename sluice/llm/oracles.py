"""DuckDB statements of the rows of registered queries, where SQL can state them plainly."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TEXT = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"


def _leads(count: int, window: str) -> str:
    """Columns n1, n2, ...: the word and those after it, joined by blanks (null beyond the end)."""
    words = ["word", *[f"lead(word, {k}) OVER {window}" for k in range(1, count)]]
    return ", ".join(f"{' || chr(32) || '.join(words[:n])} AS n{n}" for n in range(1, count + 1))


def decontaminate(window: int = 10) -> str:
    """``op3_decontaminate``: every run of words of a phrase's length, joined with the phrases."""
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    runs = " UNION ALL ".join(f"SELECT doc_id, place, {n} AS n, n{n} AS phrase FROM leads WHERE n{n} IS NOT NULL" for n in range(1, window + 1))
    return f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_TEXT}, {word}) AS w FROM benchmark
), starts AS (
  SELECT item, w, least(len(w), {window}) AS n, unnest(range(1, greatest(len(w) - {window - 1}, 1) + 1)) AS i FROM items WHERE len(w) > 0
), phrases AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM starts
), docs AS (
  SELECT doc_id, regexp_extract_all({_TEXT}, {word}) AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs
), leads AS (
  SELECT doc_id, place, {_leads(window, 'o')} FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY place)
), runs AS ({runs}
), found AS (
  SELECT r.doc_id, r.place, r.n, p.item FROM runs r JOIN phrases p ON r.n = p.n AND r.phrase = p.phrase
), hit AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(place, place + n)) AS spot FROM (SELECT DISTINCT doc_id, place, n FROM found) f) h GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) f GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN named i ON d.doc_id = i.doc_id
"""


def near_dedup(width: int = 5, percent: int = 75) -> str:
    """``op5_near_dedup``: sets of shingles joined on every shingle, and the closure of the links."""
    return rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_TEXT}, '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs
), leads AS (
  SELECT doc_id, {_leads(width, 'o')} FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY place)
), sets AS (
  SELECT DISTINCT doc_id, n{width} AS shingle FROM leads WHERE n{width} IS NOT NULL
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM docs WHERE len(w) BETWEEN 1 AND {width - 1}
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes s ON x = s.doc_id JOIN sizes t ON y = t.doc_id WHERE 100 * c >= {percent} * (s.n + t.n - c)
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT r.node, l.y FROM reach r JOIN links l ON r.seen = l.x
), least_seen AS (
  SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM docs d JOIN least_seen c ON d.doc_id = c.node LEFT JOIN sizes s ON d.doc_id = s.doc_id
"""


def collocations(least: int = 30, top: int = 2000, inside_percent: int = 80, longest: int = 4) -> str:
    """``op13_collocations``: every run of up to four words counted, every cut of the frequent ones."""
    text = _TEXT
    for c in (46, 44, 59, 58, 33, 63, 11, 12, 13):  # . , ; : ! ? and line breaks
        text = f"replace({text}, chr({c}), chr(10))"
    grams = " UNION ALL ".join(f"SELECT lang, {n} AS size, n{n} AS phrase FROM leads WHERE n{n} IS NOT NULL" for n in range(1, longest + 1))
    part = "array_to_string(w[{}:{}], ' ')"
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, string_split({text}, chr(10)) AS parts FROM documents
), pieces AS (
  SELECT id, lang, unnest(parts) AS piece, unnest(range(len(parts))) AS nth FROM texts
), split AS (
  SELECT id, lang, nth, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), words AS (
  SELECT id, lang, nth, unnest(w) AS word, unnest(range(len(w))) AS place FROM split
), leads AS (
  SELECT lang, {_leads(longest, 'o')} FROM words WINDOW o AS (PARTITION BY id, nth ORDER BY place)
), f AS (
  SELECT lang, size, phrase, count(*) AS f FROM ({grams}) g GROUP BY lang, size, phrase
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= {least}
), cuts AS (
  SELECT *, unnest(range(1, size)) AS k FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
    CAST((2000000 * CAST(c.a AS HUGEINT)) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON c.lang = x.lang AND x.phrase = {part.format(1, 'c.k').replace('w[', 'c.w[')}
    JOIN f y ON c.lang = y.lang AND y.phrase = {part.format('c.k + 1', 'c.size').replace('w[', 'c.w[')}
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored
), spans AS (
  SELECT *, unnest(range(2, size)) AS inner_size FROM candidates WHERE size > 2
), starts AS (
  SELECT *, unnest(range(1, size - inner_size + 2)) AS s FROM spans
), inside AS (
  SELECT lang, {part.format('s', 's + inner_size - 1')} AS phrase, max(a) AS longer FROM starts GROUP BY 1, 2
), ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank
  FROM lowest c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase
  WHERE c.nth = 1 AND (longer IS NULL OR 100 * CAST(longer AS HUGEINT) < {inside_percent} * CAST(a AS HUGEINT))
), totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang)
SELECT t.lang, rank, phrase, a, l, r, n, score FROM ranked q JOIN totals t ON q.lang = t.lang WHERE rank <= {top}
"""


def quality_rules(reach: float = 4.0, least: int = 100) -> str:
    """``op2_quality_rules``: the counts, the sketches of every group and the verdicts."""
    rules = {"symbols": ("n_symbols", "word_chars"), "capitals": ("n_upper", "word_chars"),
             "stutter": ("n_same_words", "n_words"), "dup_lines": ("n_dup_lines", "n_lines")}
    sizes = ("word_chars", "n_words", "n_lines")
    values = [f"SELECT lang, source, '{r}' AS rule, CAST({a} AS DOUBLE) / greatest({b}, 1) AS x FROM counts WHERE n_words > 0" for r, (a, b) in rules.items()]
    values += [f"SELECT lang, source, '{b}', CAST({b} AS DOUBLE) FROM counts WHERE n_words > 0" for b in sizes]
    least_share = "(1.0::DOUBLE / 1073741824)"
    value = f"CASE WHEN {{0}} > 0 THEN {least_share} * pow(1.02::DOUBLE, {{0}} - 0.5::DOUBLE) ELSE 0 END"

    def quantiles(name: str, groups: list[str]) -> str:
        by = ", ".join([*groups, "rule"])
        at = lambda q, c: value.format(f"min(bucket) FILTER (WHERE upto >= {q} * every)") + f" AS {c}"
        return f"""
{name}_sums AS (SELECT {by}, bucket, sum(n) AS n FROM sketch GROUP BY {by}, bucket),
{name}_upto AS (
  SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {by}) AS every FROM {name}_sums
), {name} AS (
  SELECT {by}, max(every) AS n, {at("0.1::DOUBLE", "low")}, {at("0.5::DOUBLE", "mid")}, {at("0.95::DOUBLE", "high")} FROM {name}_upto GROUP BY {by}
), """

    level = lambda t: f"({t}.mid + {reach}::DOUBLE * ({t}.mid - {t}.low))"
    part = lambda b: f"least(1.0::DOUBLE, size_{b} / greatest({b}, 1))"
    broken = ", ".join(
        f"CASE WHEN 2 * (sqrt({a} * {part(b)} + 0.375::DOUBLE) - sqrt(level_{r} * {b} * {part(b)} + 0.375::DOUBLE)) > {reach} THEN '{r}' END"
        for r, (a, b) in rules.items()
    )
    picked = ", ".join(
        [f"max(chosen) FILTER (WHERE rule = '{r}') AS level_{r}" for r in rules]
        + [f"max(size) FILTER (WHERE rule = '{b}') AS size_{b}" for b in sizes]
    )
    return rf"""
WITH docs AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM docs
), leads AS (
  SELECT doc_id, place, lag(word) OVER o = word AS same, {_leads(5, 'o')} FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY place)
), same AS (
  SELECT doc_id, count(*) FILTER (WHERE same) AS n_same_words, sum(length(n1)) AS word_chars FROM leads GROUP BY doc_id
), twice AS (
  SELECT doc_id, n5 FROM leads WHERE n5 IS NOT NULL GROUP BY doc_id, n5 HAVING count(*) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT spot) AS n_repeat_words FROM (
    SELECT l.doc_id, unnest(range(place, place + 5)) AS spot FROM leads l JOIN twice t ON l.doc_id = t.doc_id AND l.n5 = t.n5) s GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs
), line_counts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), counts AS (
  SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_same_words, 0) AS n_same_words
  FROM docs d LEFT JOIN same s ON d.doc_id = s.doc_id LEFT JOIN repeated r ON d.doc_id = r.doc_id LEFT JOIN line_counts l ON d.doc_id = l.doc_id
), sketch AS (
  SELECT lang, source, rule, CASE WHEN x > {least_share} THEN floor(ln(x / {least_share}) / ln(1.02::DOUBLE)) + 1 ELSE 0 END AS bucket, count(*) AS n
  FROM ({" UNION ALL ".join(values)}) v GROUP BY 1, 2, 3, 4
), {quantiles("own", ["lang", "source"])}{quantiles("wide", ["lang"])}{quantiles("whole", [])}chosen AS (
  SELECT o.lang, o.source, o.rule,
    CASE WHEN o.n >= {least} THEN least({level("o")}, CASE WHEN l.n >= {least} THEN greatest(l.high, {level("l")}) ELSE {level("a")} END)
         WHEN l.n >= {least} THEN {level("l")} ELSE {level("a")} END AS chosen,
    CASE WHEN o.n >= {least} THEN o.mid WHEN l.n >= {least} THEN l.mid ELSE a.mid END AS size
  FROM own o JOIN wide l ON o.lang IS NOT DISTINCT FROM l.lang AND o.rule = l.rule JOIN whole a ON o.rule = a.rule
), levels AS (
  SELECT lang, source, {picked} FROM chosen GROUP BY lang, source
), judged AS (
  SELECT c.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, concat_ws(',', {broken}) AS broken
  FROM counts c LEFT JOIN levels v ON c.lang IS NOT DISTINCT FROM v.lang AND c.source IS NOT DISTINCT FROM v.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND broken = '' AS kept, broken FROM judged
"""


def conversation_trie() -> str:
    """``op11_conversation_trie``: CRC-32 by its table, sequences named by all hashes of their
    turns, subtree sums over every node's path to the root."""
    return """
WITH RECURSIVE steps AS (
  SELECT CAST(range AS BIGINT) AS byte, CAST(range AS BIGINT) AS c, 0 AS k FROM range(256)
  UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), convs AS (
  SELECT conv_id, count(*) AS n FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crcs AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS digits, 0 AS done, CAST(4294967295 AS BIGINT) AS crc FROM convs
  UNION ALL SELECT conv_id, digits, done + 1, xor(crc >> 8, c) FROM crcs
  JOIN (SELECT byte, c FROM steps WHERE k = 8) t ON byte = xor(crc & 255, CAST(ascii(substr(digits, done + 1, 1)) AS BIGINT))
  WHERE done < length(digits)
), plan AS (
  SELECT v.conv_id, v.conv_id - v.conv_id % 5 AS base, xor(crc, 4294967295) % 9 AS head, v.n
  FROM convs v JOIN crcs ON v.conv_id = crcs.conv_id AND done = length(digits)
), lengths AS (
  SELECT p.*, least(head, coalesce(b.n, 0)) AS taken FROM plan p LEFT JOIN convs b ON p.base = b.conv_id
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rank,
    md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n_bytes
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT l.conv_id, rank AS depth, h, n_bytes FROM lengths l JOIN turns t ON l.base = t.conv_id AND rank <= taken
  UNION ALL SELECT l.conv_id, rank - head + taken, h, n_bytes FROM lengths l JOIN turns t ON l.conv_id = t.conv_id AND rank > head
), rows AS (
  SELECT conv_id, depth, string_agg(h, ',') OVER (PARTITION BY conv_id ORDER BY depth) AS path, n_bytes FROM placed
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs
), up AS (
  SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS above, max(depth) OVER (PARTITION BY conv_id) AS last FROM rows
), nodes AS (
  SELECT depth, path, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_bytes) AS n_bytes,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = last), '') AS ends
  FROM up GROUP BY depth, path
), kids AS (
  SELECT depth - 1 AS depth, above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), whole AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, p.conv_id AS parent_conv_id, (n_convs - 1) * n.n_bytes AS saved
  FROM nodes n LEFT JOIN kids k ON n.depth = k.depth AND n.path = k.path
  LEFT JOIN (SELECT depth, path, conv_id FROM nodes) p ON p.depth = n.depth - 1 AND p.path = n.above
), sums AS (
  SELECT r.depth, r.path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM whole w JOIN rows r ON r.conv_id = w.conv_id AND r.depth <= w.depth GROUP BY 1, 2
)
SELECT conv_id, w.depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM whole w JOIN sums s ON w.depth = s.depth AND w.path = s.path
"""
