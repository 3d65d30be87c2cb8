"""Registered queries of this package and, where SQL can express them, their
DuckDB equivalents over the raw tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, licenses, merkle, mixing, neardup, pii, quality, tokens, toxicity, urls, whitening
from .common import table

RULES = (
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)


def bpe_path() -> str:
    """The vocabulary file of the registered queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels"), columns=["doc_id"])
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "threshold", "rejected")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("segment_text")


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), columns=["doc_id"])


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_texts(docs, bpe_path(), ids=False, digests=True, columns=["doc_id"])


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), bpe_path()).drop("text")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).drop("url")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, neardup.Method(shingle=3, percent=85))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "cleaned_text")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.span_digests(pii.find_spans(docs, columns=["doc_id"]), ["doc_id"])


#: A user and an assistant row whose texts look like the markers of common templates.
HARD_ID, HARD_TEXT = -7, r"\### Assistant: </turn> ok"


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.range(2).select(F.lit(HARD_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD_TEXT).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat.digests(chat.format_conversations(turns))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), columns=["vec_id"])


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    manifest = merkle.document_manifest(docs, claimed=merkle.tampered_text(F.col("doc_id"), F.col("text")))
    proven = merkle.prove(manifest, claimed="claimed", digests=True)
    return proven.select("doc_id", "leaf", "subroot", F.lit(manifest.root).cast("string").alias("root"), "proof_sha256", "folded_root", "verified")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_licenses": op2_licenses,
        "op3_mix": op3_mix,
        "op4_bpe": op4_bpe,
        "op5_url_filter": op5_url_filter,
        "op6_token_counts": op6_token_counts,
        "op7_near_duplicates": op7_near_duplicates,
        "op8_quality": op8_quality,
        "op9_nearest": op9_nearest,
        "op10_pii": op10_pii,
        "op11_chat": op11_chat,
        "op12_whitening": op12_whitening,
        "op13_merkle": op13_merkle,
    }


# ---------------------------------------------------------------------------
# DuckDB side
# ---------------------------------------------------------------------------

def _ascii_lower(c: str) -> str:
    return f"translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _op2_sql() -> str:
    rows = ",\n  ".join(
        f"({i}, {_quote(t.license)}, [{', '.join(_quote(g) for g in t.bigrams)}])" for i, t in enumerate(licenses.TEMPLATES))
    norm = "trim(regexp_replace({lower}, '[^a-z0-9]+', ' ', 'g'))".format(lower=_ascii_lower("t"))
    t = licenses.THRESHOLD
    return f"""WITH templates(template, license, grams) AS (VALUES
  {rows}),
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
segments AS (
  SELECT doc_id, 'line' AS kind, unnest(range(len(l))) AS segment, unnest(l) AS t
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM docs)
  UNION ALL
  SELECT * FROM (
    SELECT doc_id, 'paragraph' AS kind, unnest(range(len(p))) AS segment, unnest(p) AS t
    FROM (SELECT doc_id, regexp_split_to_array(text, '\\n[\\x20\\x09\\x0D]*\\n') AS p FROM docs))
  WHERE contains(trim(t, chr(10)), chr(10))),
worded AS (SELECT doc_id, kind, segment, string_split({norm}, ' ') AS w FROM segments),
grams AS (
  SELECT doc_id, kind, segment,
         list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS b
  FROM worded WHERE len(w) >= 2),
scored AS (
  SELECT g.doc_id, g.kind, g.segment, s.license, s.template,
         CAST(2.0 AS DOUBLE) * len(list_intersect(g.b, s.grams)) / (len(g.b) + len(s.grams)) AS dice
  FROM grams g JOIN templates s ON list_has_any(g.b, s.grams)),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, kind, segment ORDER BY dice DESC, template) AS n
  FROM scored WHERE dice >= CAST({t} AS DOUBLE))
SELECT doc_id, kind, CAST(segment AS INTEGER) AS segment, license, template, dice FROM best WHERE n = 1"""


def _op5_sql() -> str:
    cases = []
    for r in sorted(RULES, key=lambda r: -len(r.key)):
        fits = f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        cases.append((fits, r.key, r.action))
    rest = "CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END"
    return f"""WITH rests AS (SELECT page_id, coalesce({rest}, '') AS rest FROM pages),
parts AS (
  SELECT page_id, {_ascii_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests)
SELECT page_id, host, path,
       CASE {' '.join(f"WHEN {f} THEN '{k}'" for f, k, _ in cases)} END AS rule,
       CASE {' '.join(f"WHEN {f} THEN '{a}'" for f, _, a in cases)} ELSE 'allow' END AS verdict
FROM parts"""


def _op7_sql() -> str:
    """All pairs that share a shingle, by brute force."""
    return f"""WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_ascii_lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] END) AS s FROM worded),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS total, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (total - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, seen) AS (
  SELECT DISTINCT a, a FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.seen = e.a),
roots AS (SELECT node, min(seen) AS root FROM reach GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(root, doc_id) AS component_id,
       coalesce(root, doc_id) = doc_id AS kept
FROM sets LEFT JOIN roots ON doc_id = node"""


def _op8_sql() -> str:
    q = quality
    ws = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    symbols = "(length({c}) - length(regexp_replace({c}, '" + q.SYMBOLS + "', '', 'g')))"
    body = f"trim(l, {ws})"
    fails = (
        f"(NOT regexp_matches(b, {_quote(q.SENTENCE_END)}) OR regexp_matches(b, {_quote(q.NAVIGATION)})"
        f" OR regexp_matches({_ascii_lower('b')}, {_quote('|'.join(q.BOILERPLATE))})"
        f" OR 100 * {symbols.format(c='b')} > {q.MAX_SYMBOL_PERCENT} * length(b))"
    )
    return f"""WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
worded AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM docs),
windows AS (
  SELECT r, i, array_to_string(w[i:i + {q.WINDOW - 1}], ' ') AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i FROM worded)),
repeats AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT r, sum(least({q.WINDOW}, coalesce(nxt - i, {q.WINDOW}))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM repeats) GROUP BY r),
lines AS (
  SELECT r, l, b, {fails} AS failed
  FROM (SELECT r, l, {body} AS b FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM docs)) WHERE b <> ''),
line_sums AS (
  SELECT r, count(*) - count(DISTINCT l) AS dup, sum(length(l)) AS line_chars,
         coalesce(sum(length(l)) FILTER (WHERE failed), 0) AS lost_chars
  FROM lines GROUP BY r),
base AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         {symbols.format(c='text')} AS n_symbols, coalesce(dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         coalesce(line_chars, 0) AS line_chars, coalesce(lost_chars, 0) AS lost_chars
  FROM worded LEFT JOIN covered c USING (r) LEFT JOIN line_sums USING (r)),
judged AS (
  SELECT *, (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM base)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, CAST(line_chars AS BIGINT) AS line_chars,
       CAST(lost_chars AS BIGINT) AS lost_chars,
       (NOT base_failed AND NOT (100 * lost_chars > {q.MAX_LOST_PERCENT} * line_chars)) AS kept
FROM judged"""


def _op3_sql() -> str:
    m = mixing
    weights = ", ".join(map(str, m.WEIGHTS))
    return f"""WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
ranked AS (
  SELECT *, {m.MAX_REPEATS} * source_size AS cap, CAST(list_extract([{weights}], 1 + (r - 1) % {len(m.WEIGHTS)}) AS DOUBLE) AS weight
  FROM (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r
        FROM docs GROUP BY source)),
levels AS (
  SELECT *, (sum(source_size) OVER () * CAST({m.BUDGET[0]} AS DOUBLE) / CAST({m.BUDGET[1]} AS DOUBLE)
             - CAST(coalesce(sum(cap) OVER (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
            / sum(weight) OVER (ORDER BY cap / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
targets AS (
  SELECT source, r, weight, source_size, least(CAST(cap AS DOUBLE), weight * max(level) OVER ()) AS target FROM levels),
ordered AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.r, t.weight, row_number() OVER () AS id,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY h, CAST(doc_id AS VARCHAR), size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pos
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
items AS (
  SELECT id, size, sum(size) OVER (ORDER BY pos / weight, r, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
  FROM (SELECT id, size, r, weight, pos + source_size * k AS pos FROM ordered, range({m.MAX_REPEATS}) reps(k) WHERE size > 0)),
taken AS (
  SELECT id, sum(size) AS taken FROM items
  WHERE {m.BUDGET[1]} * used <= {m.BUDGET[0]} * (SELECT sum(size) FROM docs) GROUP BY id)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM ordered LEFT JOIN taken USING (id)"""


OP9_SQL = """WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10"""


def _op11_sql() -> str:
    """Straight from the rows: digests of the turns, and the length of the template around them."""
    hard = _quote(HARD_TEXT)
    escaped = "length(regexp_replace({c}, '<(\\\\*/?turn)', '<\\\\\\1', 'g'))"
    order = "turn NULLS FIRST, role, text"
    return f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({HARD_ID}, 0, 'user', {hard}), ({HARD_ID}, 1, 'assistant', {hard})),
sized AS (
  SELECT *, {escaped.format(c='text')} + CASE
           WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY {order}) = role THEN length('<turn-also>')
           ELSE length('<turn><turn-text></turn>') + 1 + {escaped.format(c='role')} END AS n
  FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY {order})) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY {order}) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


def _op13_sql(levels: int = 7, top_levels: int = 4) -> str:
    """The trees level by level, unrolled: up to 8^levels leaves a language and 8^top_levels languages."""
    def leaf(text: str) -> str:
        parts = []
        for c in merkle.FIELDS:
            v = text if c == "text" else f"CAST({c} AS VARCHAR)"
            parts.append(f"coalesce(strlen({v}) || ':' || {v}, '-')")
        return f"sha256({' || '.join(parts)})"

    bits = "list_reduce(list_prepend(xor(crc, b), range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    data = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {data}), lambda crc, b: {bits}), 4294967295)"
    order = "doc_id NULLS FIRST, leaf"

    def climb(name: str, first: str, n: int) -> list[str]:
        """CTEs of the nodes (k, i, w, h) level by level, from ``first``, and of their runs."""
        out = [f"{name}0 AS ({first})"]
        for x in range(n):
            out.append(f"""{name}{x + 1} AS (
  SELECT k, i // 8 AS i, (w + 7) // 8 AS w, CASE WHEN w > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h
  FROM {name}{x} GROUP BY k, i // 8, w)""")
            out.append(f"{name}run{x} AS (SELECT k, i // 8 AS p, w, list(h ORDER BY i) AS hs FROM {name}{x} GROUP BY k, i // 8, w)")
        return out

    def walk(name: str, nodes: str, first: str, n: int) -> list[str]:
        """CTEs of the rows on their way up: place (k, i), digests met and the root folded so far."""
        out = [f"{name}0 AS ({first})"]
        for x in range(n):
            before, after = "array_to_string(hs[1:(i % 8)], '')", "array_to_string(hs[(i % 8) + 2:], '')"
            out.append(f"""{name}{x + 1} AS (
  SELECT s.* REPLACE (i // 8 AS i, CASE WHEN w > 1 THEN proof || {before} || {after} ELSE proof END AS proof,
                      CASE WHEN w > 1 THEN sha256({before} || f || {after}) ELSE f END AS f)
  FROM {name}{x} s JOIN {nodes}run{x} r ON s.k = r.k AND s.i // 8 = r.p)""")
        return out

    ctes = [
        f"""hit AS (SELECT *, CASE WHEN {crc} % 3 = 0 THEN {_ascii_lower('text')} ELSE text END AS other FROM documents)""",
        f"""leaves AS (SELECT doc_id, coalesce('v' || lang, 'n') AS k, {leaf('text')} AS leaf, {leaf('other')} AS claimed FROM hit)""",
        f"""placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY {order}) - 1 AS i, count(*) OVER (PARTITION BY k) AS w FROM leaves)""",
        *climb("n", "SELECT k, i, w, leaf AS h FROM placed", levels),
        *climb("t", f"SELECT '' AS k, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS w, h FROM n{levels}", top_levels),
        f"tops AS (SELECT k, h, row_number() OVER (ORDER BY k) - 1 AS i FROM n{levels})",
        *walk("s", "n", "SELECT doc_id, leaf, k, i, '' AS proof, claimed AS f FROM placed", levels),
        *walk("u", "t", f"SELECT doc_id, leaf, h AS subroot, '' AS k, tops.i AS i, proof, f FROM s{levels} s JOIN tops ON s.k = tops.k", top_levels),
    ]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = root.h AS verified
FROM u{top_levels}, t{top_levels} AS root"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_licenses": _op2_sql(),
        "op3_mix": _op3_sql(),
        "op5_url_filter": _op5_sql(),
        "op7_near_duplicates": _op7_sql(),
        "op8_quality": _op8_sql(),
        "op9_nearest": OP9_SQL,
        "op11_chat": _op11_sql(),
        "op13_merkle": _op13_sql(),
    }
