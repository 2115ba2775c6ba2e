"""DuckDB SQL for those operators that SQL can express."""

OP7 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

OP9 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('17:' || doc_id::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0 AS drawn
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3)::INT]::DOUBLE AS w
  FROM sized GROUP BY source),
run AS (
  SELECT *, 3.0 * source_size AS most, sum(source_size) OVER () AS total,
         coalesce(sum(3.0 * source_size) OVER b, 0) AS full_before, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS w_left
  FROM src WINDOW b AS (ORDER BY 3.0 * source_size / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (
  SELECT (total - full_before) / w_left AS level FROM run
  WHERE most >= w * (total - full_before) / w_left ORDER BY most / w, encode(source) NULLS LAST LIMIT 1),
tgt AS (
  SELECT source, source_size, least(most, w * (SELECT level FROM lev))::DOUBLE AS target FROM run),
taken AS (
  SELECT s.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0) ELSE 0.0 END AS rate
  FROM sized s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + (drawn < rate - floor(rate))::BIGINT))::BIGINT AS taken, rate::DOUBLE AS rate,
       (floor(rate)::BIGINT + (drawn < rate - floor(rate))::BIGINT) AS copies
FROM taken
"""

OP2 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS r FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> r THEN r END AS refers_to, true AS verified
FROM g
"""

OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""



def _crc32(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of an ASCII string."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)"
    return f"xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split({text}, ''), lambda y: ascii(y)::UBIGINT)), lambda c, b: {step}), 4294967295)"


def _tree(name: str, levels: int) -> str:
    """CTEs for the levels above ``name0`` (g, i, d, n): runs of 8 are hashed while a tree has several nodes; ``l`` and ``r`` are the siblings."""
    out = []
    for k in range(levels):
        out.append(f"""{name}s{k} AS (SELECT g, i, n, coalesce(string_agg(d, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(d, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k}),
{name}{k + 1} AS (SELECT g, i // 8 AS i, CASE WHEN max(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE max(d) END AS d, (max(n) + 7) // 8 AS n FROM {name}{k} GROUP BY g, i // 8)""")
    return ",\n".join(out)


def _op11(low: int = 8, high: int = 4) -> str:
    """Unrolled for up to 8^low documents a language and 8^high languages; smaller trees pass through the levels above their own."""
    def field(f: str) -> str:
        return f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')"
    head = " || ".join(field(f) for f in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    joins = [(f"x{k}", f"JOIN a_s{k} x{k} ON x{k}.g = o.g AND x{k}.i = o.i // {8 ** k}") for k in range(low)]
    joins += [(f"y{k}", f"JOIN b_s{k} y{k} ON y{k}.i = o.g // {8 ** k}") for k in range(high)]
    names, steps, at = [x for x, _ in joins], [], "claim"
    for x in names:
        steps.append(f"CASE WHEN {x}.n > 1 THEN sha256({x}.l || {at} || {x}.r) ELSE {at} END AS {x}f")
        at = f"{x}f"
    return f"""
WITH o AS (
  SELECT doc_id, lang, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, sha256({head} || {field('text')}) AS leaf,
         CASE WHEN coalesce({_crc32("coalesce(doc_id::VARCHAR, '')")} % 3 = 0, false) AND doc_id IS NOT NULL THEN sha256({head} || {field(lower)}) ELSE sha256({head} || {field('text')}) END AS claim
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM o),
a_0 AS (SELECT g, i, leaf AS d, n FROM p),
{_tree('a_', low)},
b_0 AS (SELECT 0 AS g, g AS i, d, count(*) OVER () AS n FROM a_{low}),
{_tree('b_', high)},
f AS (SELECT o.doc_id, o.leaf, t.d AS subroot, (SELECT d FROM b_{high}) AS root, sha256({' || '.join(f'{x}.l || {x}.r' for x in names)}) AS proof_sha256,
  {', '.join(steps)}
  FROM p o JOIN b_0 t ON t.i = o.g {' '.join(j[1] for j in joins)})
SELECT doc_id, leaf, subroot, root, proof_sha256, {at} AS folded_root, {at} = root AS verified FROM f
"""


def _op12() -> str:
    """A forward DP row by row; v0 to v3 are the cheapest (cost, audit, lines) that end with nothing, a system, a user or an assistant row."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

    def known(c: str) -> str:
        return f"coalesce({c}::VARCHAR, ' ')"

    def edit(v: str, cost: str, letter: str, line: str | None) -> str:
        lines = f"{v}['r']" if line is None else f"list_append({v}['r'], {line})"
        return f"{{'c': ({v}['c'] + {cost})::BIGINT, 'a': {v}['a'] || {letter}, 'r': {lines}}}"

    def best(*of: str) -> str:
        return f"list_min([{', '.join(of)}])"

    def start(cost: int) -> str:
        return f"{{'c': {cost}::BIGINT, 'a': '', 'r': []::VARCHAR[]}}"
    inserted = (f"SELECT *, {best('v2', *[edit(v, '2', chr(39) + 'I' + chr(39), chr(39) + 'user:' + chr(39)) for v in ('v0', 'v1', 'v3')])} AS u, "
                f"{best('v3', edit('u', '2', chr(39) + 'I' + chr(39), chr(39) + 'assistant:' + chr(39)))} AS a")

    def into(v: str, initial: str, name: str) -> str:
        own = f"CASE WHEN initial = '{initial}'"
        return edit(v, f"{own} THEN cut ELSE 2 + cut END", f"{own} THEN 'K' ELSE 'R' END", f"{own} THEN role ELSE '{name}' END || ':' || text")
    gone = {v: edit(v, "3", "'D'", None) for v in ("v0", "v1", "u", "a")}
    return f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, {known('role')} AS role, {known('text')} AS text, {_crc32(known('conv_id') + " || ':' || " + known('turn'))} % 20 AS kind FROM conversations),
e AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(len(role) || ':' || role || text)) AS p, rtrim(text, {white}) AS bare FROM e),
w AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again, left(role, 1) AS initial,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) || left(role, 1) AS pair FROM o),
f AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             (bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?'))::INT AS cut FROM w),
d AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS p, {start(0)} AS v0, {start(10 ** 9)} AS v1, {start(10 ** 9)} AS v2, {start(10 ** 9)} AS v3 FROM conversations
  UNION ALL
  SELECT d.conv_id, d.p + 1, {gone['v0']}, CASE WHEN fault NOT IN ('blank', 'duplicate') AND initial = 's' THEN {best(gone['v1'], edit('v0', 'cut', "'K'", "role || ':' || text"))} ELSE {gone['v1']} END,
         CASE WHEN fault IN ('blank', 'duplicate') THEN {gone['u']} ELSE {best(gone['u'], *[into(v, 'u', 'user') for v in ('v0', 'v1', 'a')])} END,
         CASE WHEN fault IN ('blank', 'duplicate') THEN {gone['a']} ELSE {best(gone['a'], into('u', 'a', 'assistant'))} END
  FROM ({inserted} FROM d) d JOIN f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.p = d.p + 1),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
             count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM f GROUP BY conv_id)
SELECT z.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, x['c'] AS cost, x['a'] AS audit, sha256(array_to_string(x['r'], chr(10))) AS repaired_sha256
FROM (SELECT d.conv_id, gaps, blank, duplicate, truncated, illegal, {best('v0', 'a')} AS x
      FROM ({inserted} FROM d) d LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM d.conv_id WHERE d.p = coalesce(n.n, 0)) z
"""


ORACLE_SQL = {"op12_conversations": _op12(), "op11_merkle": _op11(), "op2_warc": OP2, "op3_top_k": OP3, "op7_exact_dedup": OP7, "op9_source_mix": OP9}
