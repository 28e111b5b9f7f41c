"""The results of the corpus operators in the checking engine's SQL, where it can express them."""

from __future__ import annotations

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
GAP = r"'[\x20\x09-\x0D]+'"
#: Levels of the mixing tree that the SQL spells out; enough for 256 ** LEVELS documents of a source.
LEVELS = 2


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(COALESCE({text}, ''), {GAP}), lambda w: w <> '')"


def op5_mixing() -> str:
    # sources weigh 5, 2, 1, share 150 % and stop at twice their size; blocks are of 256

    def draw(tag: str, bits: str = "CAST(id AS VARCHAR), salt") -> str:
        return f"CAST('0x' || substr(md5(concat_ws(':', 'mix', {tag}, {bits})), 1, 10) AS BIGINT)"

    parts = [
        f"""docs AS (SELECT CAST(doc_id AS BIGINT) AS id, source, len({words("text")}) AS size, substr(md5(text), 1, 16) AS salt FROM documents)""",
        "sizes AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, COUNT(*) FILTER (size > 0) AS units FROM docs GROUP BY source)",
        f"""weighed AS (SELECT *, source_size * 2 AS bound, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sizes)""",
        f"""leveled AS (SELECT *, SUM(source_size) OVER () * CAST(1.5 AS DOUBLE) AS total,
  bound / weight <= (SUM(source_size) OVER () * CAST(1.5 AS DOUBLE) - COALESCE(SUM(bound) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / SUM(weight) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full FROM weighed)""",
        """targets AS (SELECT source, source_size, units, CASE WHEN is_full THEN CAST(bound AS DOUBLE)
  ELSE (total - SUM(CASE WHEN is_full THEN bound ELSE 0 END) OVER ()) / SUM(CASE WHEN is_full THEN 0 ELSE weight END) OVER () * weight END AS target FROM leveled)""",
        """fractions AS (SELECT d.*, t.source_size, t.target, t.units, CAST(floor(c) AS BIGINT) AS base, c - floor(c) AS p FROM (
  SELECT d.*, CASE WHEN size > 0 THEN target / source_size ELSE 0 END AS c FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source) d
  JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)""",
        "units_0 AS (SELECT id, source, salt, size, source_size, target, base, p, units FROM fractions WHERE p > 0)",
    ]
    for level in range(LEVELS):
        parts += [
            f"""placed_{level} AS (SELECT *, {draw(f"'block', '{level}'")} % blocks AS block, {draw(f"'{level}'")} / CAST({2**40} AS DOUBLE) AS draw
  FROM (SELECT *, greatest(CAST(ceil(units / 256) AS BIGINT), 1) AS blocks FROM units_{level}) x)""",
            f"""run_{level} AS (SELECT *, row_number() OVER (PARTITION BY source, block ORDER BY size DESC, id NULLS FIRST, salt NULLS FIRST) AS k FROM placed_{level})""",
            f"""walk_{level} AS (
  SELECT source, block, k, k AS hk, size AS hs, least(greatest(p, 0), 1) AS hp, CAST(NULL AS BIGINT) AS done, CAST(NULL AS INTEGER) AS pick FROM run_{level} WHERE k = 1
  UNION ALL
  SELECT source, block, k, CASE WHEN holder_done THEN k ELSE hk END, CASE WHEN holder_done THEN size ELSE hs END,
   least(greatest(CASE WHEN rises AND holder_done THEN p - up / size WHEN rises THEN hp + up / hs WHEN holder_done THEN p + down / size ELSE hp - down / hs END, 0), 1),
   CASE WHEN holder_done THEN hk ELSE k END, CASE WHEN rises AND holder_done THEN 1 WHEN rises THEN 0 WHEN holder_done THEN 0 ELSE 1 END
  FROM (SELECT *, CASE WHEN rises THEN (1 - hp) * hs <= p * size ELSE hp * hs <= (1 - p) * size END AS holder_done
   FROM (SELECT *, draw * (up + down) < down AS rises FROM (
    SELECT w.source, w.block, r.k, hk, hs, hp, r.size, r.p, r.draw, least((1 - hp) * hs, r.p * r.size) AS up, least(hp * hs, (1 - r.p) * r.size) AS down
    FROM walk_{level} w JOIN run_{level} r ON w.source IS NOT DISTINCT FROM r.source AND w.block = r.block AND r.k = w.k + 1) a) b) c)""",
            f"""last_{level} AS (SELECT * FROM (SELECT *, MAX(k) OVER (PARTITION BY source, block) AS last FROM walk_{level}) x WHERE k = last)""",
            f"""units_{level + 1} AS (SELECT r.id, r.source, r.salt, r.size, r.source_size, r.target, r.base, l.hp AS p, r.blocks AS units
  FROM last_{level} l JOIN run_{level} r ON l.source IS NOT DISTINCT FROM r.source AND l.block = r.block AND l.hk = r.k)""",
            f"""decided_{level} AS (SELECT r.id, r.source, r.salt, r.size, r.source_size, r.target, r.base, w.pick
  FROM walk_{level} w JOIN run_{level} r ON w.source IS NOT DISTINCT FROM r.source AND w.block = r.block AND w.done = r.k)""",
        ]
    result = " UNION ALL ".join(
        ["SELECT id, size, source_size, target, base + 0 AS copies FROM fractions WHERE NOT p > 0"]
        + [f"SELECT id, size, source_size, target, base + pick FROM decided_{level}" for level in range(LEVELS)]
        + [f"SELECT id, size, source_size, target, base + CASE WHEN {draw(chr(39) + 'last' + chr(39))} / CAST({2**40} AS DOUBLE) < p THEN 1 ELSE 0 END FROM units_{LEVELS}"]
    )
    return f"WITH RECURSIVE {', '.join(parts)} SELECT id AS doc_id, size, source_size, target, size * copies AS taken, copies FROM ({result}) r"


def op6_lines(chunks: bool) -> str:
    """Spans of lines that repeat: pairs of neighbouring lines with a word, lines of more than 50 words and, if asked for, chunks of two or more lines."""
    rolled = "md5(string_agg(md5(line), '') OVER (PARTITION BY row_no ORDER BY i ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING))"
    with_chunks = f""",
hashed AS (SELECT row_no, i, {rolled} AS h FROM lines),
cuts AS (SELECT row_no, i FROM (SELECT *, lag(h) OVER (PARTITION BY row_no ORDER BY i) AS before, lead(h) OVER (PARTITION BY row_no ORDER BY i) AS after FROM hashed) x
 WHERE i = 0 OR (h < before AND h <= after)),
chunks AS (SELECT row_no, i AS start, COALESCE(lead(i) OVER (PARTITION BY row_no ORDER BY i), len(ls)) - i AS n FROM cuts JOIN docs USING (row_no))"""
    more = "SELECT row_no, start, n FROM chunks WHERE n > 1 UNION ALL "
    return f"""WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, text, string_split(text, chr(10)) AS ls,
 dense_rank() OVER (ORDER BY doc_id NULLS FIRST, substr(md5(text), 1, 16) NULLS FIRST) AS place FROM documents),
lines AS (SELECT row_no, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i FROM docs),
full_lines AS (SELECT *, lead(i) OVER (PARTITION BY row_no ORDER BY i) AS next_i FROM lines WHERE trim(line, {SPACES}) <> ''){with_chunks if chunks else ""},
spans AS ({more if chunks else ""}SELECT row_no, i AS start, next_i - i + 1 AS n FROM full_lines WHERE next_i IS NOT NULL
 UNION ALL SELECT row_no, i, 1 FROM full_lines WHERE len({words("line")}) > 50),
bodies AS (SELECT row_no, place, start, n, array_to_string(ls[start + 1:start + n], chr(10)) AS body FROM spans JOIN docs USING (row_no)),
firsts AS (SELECT body, MIN(struct_pack(place := place, start := start)) AS f FROM bodies WHERE trim(body, {SPACES}) <> '' GROUP BY body),
gone AS (SELECT DISTINCT row_no, unnest(range(start, start + n)) AS i FROM bodies b JOIN firsts f ON f.body = b.body WHERE f.f.place <> b.place OR f.f.start + n <= b.start),
kept AS (SELECT row_no, string_agg(line, chr(10) ORDER BY i) AS body, COUNT(*) AS n FROM lines l ANTI JOIN gone g ON g.row_no = l.row_no AND g.i = l.i GROUP BY row_no)
SELECT doc_id, CAST(COALESCE(len(ls), 0) AS BIGINT) AS n_lines, CAST(COALESCE(len(ls) - COALESCE(k.n, 0), 0) AS BIGINT) AS n_removed,
 CASE WHEN text IS NULL THEN NULL ELSE COALESCE(k.body, '') END AS text FROM docs d LEFT JOIN kept k ON k.row_no = d.row_no"""


def op6_line_dedup() -> str:
    return op6_lines(chunks=True)


def op6_line_runs() -> str:
    return op6_lines(chunks=False)


def op7_quality_rules() -> str:
    return f"""WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, source AS host, COALESCE(text, '') AS body, {words("text")} AS ws FROM documents),
placed AS (SELECT row_no, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM docs),
grams AS (SELECT row_no, i, CASE WHEN lead(i, 4) OVER o IS NOT NULL THEN concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) END AS g
 FROM placed WINDOW o AS (PARTITION BY row_no ORDER BY i)),
hits AS (SELECT row_no, i, CASE WHEN g IS NOT NULL AND COUNT(*) OVER (PARTITION BY row_no, g) > 1 THEN 1 ELSE 0 END AS hit FROM grams),
covered AS (SELECT row_no, MAX(hit) OVER (PARTITION BY row_no ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM hits),
repeats AS (SELECT row_no, SUM(c) AS n FROM covered GROUP BY row_no),
measured AS (SELECT d.row_no, doc_id, host, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
 length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
 len(list_filter(string_split(body, chr(10)), lambda x: trim(x, {SPACES}) <> '')) - len(list_distinct(list_filter(string_split(body, chr(10)), lambda x: trim(x, {SPACES}) <> ''))) AS n_dup_lines,
 len(string_split(body, chr(10))) AS n_lines, COALESCE(r.n, 0) AS n_repeat_words FROM docs d LEFT JOIN repeats r USING (row_no)),
judged AS (SELECT *, base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines AS failed
 FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured) x),
hosts AS (SELECT host, COUNT(*) AS n, COUNT(*) FILTER (failed) AS f FROM judged GROUP BY host),
totals AS (SELECT SUM(n) AS docs, SUM(f) / SUM(n) AS mean, SUM(CAST(n AS DOUBLE) * n) AS squares, SUM(CAST(f AS DOUBLE) * f / n) AS spread, COUNT(*) AS hosts FROM hosts),
prior AS (SELECT mean, CASE WHEN (docs - squares / docs) * mean * (1 - mean) > 0
 THEN least(greatest((spread - docs * mean * mean - (hosts - 1) * mean * (1 - mean)) / ((docs - squares / docs) * mean * (1 - mean)), 0), 1) ELSE 0 END AS alike FROM totals),
rated AS (SELECT *, rate > 0.5 AS host_refused FROM (SELECT host, CASE WHEN alike > 0 THEN n * alike / (n * alike + 1 - alike) * f / n + (1 - n * alike / (n * alike + 1 - alike)) * mean ELSE mean END AS rate
 FROM hosts, prior) x)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
 CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT host_refused AS kept, host_refused, CAST(floor(rate * 1000000 + 0.5) AS BIGINT) AS host_rate_ppm
FROM judged j JOIN rated r ON j.host IS NOT DISTINCT FROM r.host"""


def op11_collocations() -> str:
    lowered = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""WITH pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM (
  SELECT COALESCE(lang, 'und') AS lang, unnest(regexp_split_to_array({lowered}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents) x),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
counted AS MATERIALIZED (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, COUNT(*) AS a FROM starts, range(1, 6) r(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL),
totals AS (SELECT lang, CAST(SUM(a) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM counted WHERE k > 1 AND a >= 100),
parts AS MATERIALIZED (SELECT lang, phrase, a FROM counted WHERE a >= 100),
cuts AS MATERIALIZED (SELECT lang, phrase, a, c, array_to_string(ws[:c], ' ') AS head, array_to_string(ws[c + 1:], ' ') AS tail FROM candidates, range(1, 5) r(c) WHERE c < k),
heads AS MATERIALIZED (SELECT c.*, p.a AS l FROM cuts c JOIN parts p ON p.lang = c.lang AND p.phrase = c.head),
both_parts AS MATERIALIZED (SELECT c.*, p.a AS r FROM heads c JOIN parts p ON p.lang = c.lang AND p.phrase = c.tail),
scores AS (SELECT b.lang, phrase, a, c, l, r, n, CAST(1000 * CAST(a AS HUGEINT) * n // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM both_parts b JOIN totals o ON o.lang = b.lang),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_parts AS (SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM candidates, range(2, 5) r(m), range(1, 5) s(i) WHERE m < k AND i + m - 1 <= k),
absorbed AS (SELECT lang, phrase, MAX(a) AS longer FROM inner_parts GROUP BY lang, phrase),
kept AS (SELECT w.* FROM lowest w LEFT JOIN absorbed b ON b.lang = w.lang AND b.phrase = w.phrase WHERE b.longer IS NULL OR 100 * b.longer < 100 * w.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) x WHERE rank <= 2000"""


def op12_merkle() -> str:
    # CRC-32 by its definition: a byte is added to the register, which then takes eight steps
    steps = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda r, s: CASE WHEN s >= 0 THEN xor(r, s) ELSE xor(r >> 1, 3988292384 * (r & 1)) END), 4294967295)"

    def digest(text: str) -> str:
        fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(concat(" + ", ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields) + "))"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def levels(name: str, start: str) -> str:
        return f"""{name} AS ({start} UNION ALL SELECT tree, level + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos)), (n + 15) // 16
 FROM {name} WHERE n > 1 GROUP BY tree, level, n, pos // 16)"""

    return f"""WITH RECURSIVE hashed AS MATERIALIZED (SELECT doc_id, source, {digest("text")} AS leaf,
 CASE WHEN {crc} % 5 = 0 THEN {digest(lowered)} ELSE {digest("text")} END AS tampered FROM documents),
leaves AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, COUNT(*) OVER (PARTITION BY source) AS n,
 row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, tampered) - 1 AS pos FROM hashed),
{levels("below", "SELECT tree, CAST(0 AS BIGINT) AS level, pos, leaf AS hash, n FROM leaves")},
subroots AS (SELECT tree, level, hash FROM below WHERE n = 1),
{levels("above", "SELECT CAST(-1 AS BIGINT) AS tree, CAST(0 AS BIGINT) AS level, tree AS pos, hash, (SELECT COUNT(*) FROM subroots) AS n FROM subroots")},
runs AS (SELECT tree, level, pos // 16 AS run, string_agg(hash, '' ORDER BY pos) AS joined FROM (SELECT * FROM below WHERE n > 1 UNION ALL SELECT * FROM above WHERE n > 1) x GROUP BY tree, level, pos // 16),
families AS (SELECT r.tree, r.level, r.run, joined, CASE WHEN b.n = 1 AND r.tree >= 0 THEN -1 ELSE r.tree END AS up_tree,
 CASE WHEN b.n = 1 AND r.tree >= 0 THEN 0 ELSE r.level + 1 END AS up_level, CASE WHEN b.n = 1 AND r.tree >= 0 THEN r.tree ELSE r.run END AS up_pos
 FROM runs r JOIN (SELECT * FROM below UNION ALL SELECT * FROM above) b ON b.tree = r.tree AND b.level = r.level + 1 AND b.pos = r.run),
climb AS (SELECT tree AS of_tree, pos AS of_pos, CASE WHEN n = 1 THEN -1 ELSE tree END AS tree, CAST(0 AS BIGINT) AS level, CASE WHEN n = 1 THEN tree ELSE pos END AS pos, tampered AS folded, '' AS proof FROM leaves
 UNION ALL SELECT of_tree, of_pos, up_tree, up_level, up_pos, sha256(joined[:pos % 16 * 64] || folded || joined[pos % 16 * 64 + 65:]),
  proof || joined[:pos % 16 * 64] || joined[pos % 16 * 64 + 65:]
 FROM climb c JOIN families f ON f.tree = c.tree AND f.level = c.level AND f.run = c.pos // 16),
ended AS (SELECT of_tree, of_pos, folded, proof FROM climb QUALIFY row_number() OVER (PARTITION BY of_tree, of_pos ORDER BY length(proof) DESC) = 1)
SELECT doc_id, leaf, s.hash AS subroot, t.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.hash AS verified
FROM leaves l JOIN ended e ON e.of_tree = l.tree AND e.of_pos = l.pos JOIN subroots s ON s.tree = l.tree CROSS JOIN (SELECT hash FROM above WHERE n = 1) t"""


def statements() -> dict[str, str]:
    return {f.__name__: f() for f in (op5_mixing, op6_line_dedup, op6_line_runs, op7_quality_rules, op11_collocations, op12_merkle)}
