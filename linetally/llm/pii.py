"""PII: patterns, and information-theoretic sanitisation of what surrounds them.

Patterns find e-mail addresses, IP addresses, card and phone numbers; their
values are the protected entities. A term near an entity can give it away even
when the entity itself is removed, and how much it does follows from the corpus.
With ``p(x)`` the share of different texts that hold x, and ``p(e | t)`` that of
those with the term that have it near the entity, somebody who sees the term
has ``-log2 p(e | t)`` bits left to learn about the entity, of ``-log2 p(e)`` before; the difference
is what the term told. It discloses the entity if at most :data:`LEFT_GENERALISE` bits are left and
it told more than it left, :data:`TIMES` that and :data:`LEARNED` bits; it is generalised then (to the kind of word it is), and
removed if at most :data:`LEFT_REMOVE` bits are left, in that entity's surroundings. ``p(e | t)`` is the
lower confidence bound (Wilson's, :data:`Z`) of the share met, so that one encounter counts
less than ten. It depends on the numbers of texts with term and entity alone, not
on the size of the corpus: that only enters as p(e), so an entity that many of few texts hold needs more evidence
(with these constants, one in more than 0.78 % of the texts).
Copies of one text are one encounter.

How it runs. A first pass finds the entities and the terms near them, and writes both with a 128-bit
digest of the text, by which copies are known; no text is shuffled. The encounters, bounded by
the entities' occurrences, are counted by pair. As ``p(e | t)`` is below ``n / n_t``, a term met in n texts
near an entity matters only if it is in at most about ``4 n`` texts (:func:`most_texts`). So a second pass
gathers, for such terms only, the digests of up to that many texts in each task, else the one fact that
there are more, and n_t is the number of different digests. Which terms, and how many texts, is told by a table of
:data:`SLOTS` bytes, whatever their number: terms that share a slot share the greater
number, which costs rows but changes no count. Then only documents with entities meet the disclosing pairs; joins are
salted, so that an entity or a text that a third of all rows hold is spread over tasks.

Results for odd input: null and empty texts have no spans; texts of any length are
read whole; identical rows get identical spans; a row without id is treated
like any other; overlapping spans are replaced as one, by the marker of the
first; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import carried, release_tables, returning_memory, slices, whole_text

KINDS = ("email", "ip", "card", "phone", "term")
COUNTS = ("n_email", "n_ip", "n_card", "n_phone")
_SPAN = "array<struct<kind:string,start:int,end:int>>"
_NEAR = "array<struct<e:string,t:string,start:int,end:int>>"
#: Words, and at most characters, on either side of an entity that are near it.
REACH = 8
REACH_CHARS = 200
#: Bits left to learn about an entity at which a term is generalised, or removed.
LEFT_GENERALISE = 2.0
LEFT_REMOVE = 1.0
#: A term must have told TIMES as many bits as it leaves, and LEARNED more.
TIMES = 2.0
LEARNED = 1.0
#: Normal quantile of the confidence bound (one-sided, 95 %).
Z = 1.645
#: Slots of the table of terms to be counted (a byte each).
SLOTS = 1 << 22
#: Text digests a worker gathers before it passes them on, and words whose slots it keeps.
FLUSH = 300_000
#: Parts into which rows of one key are dealt in a join.
SALTS = 16

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a number is read from its first digit, so a run of digits is tried once
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]{3,}")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches. A match starts where its run of local characters does (or
    where the match before ended), so each @ is looked at once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end in code points) of the patterns, by kind, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGITS.findall(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def entity(kind: str, value: str) -> str:
    """One name for all spellings of an entity."""
    if kind in ("card", "phone"):
        value = "".join(_DIGITS.findall(value))
    return f"{kind}:{value.lower()}"


def surroundings(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the whole terms near each span, apart from the spans."""
    out = []
    starts, ends = [], []  # of the stretches that spans cover, apart from each other
    for a, b in sorted((a, b) for _, a, b in spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for kind, a, b in spans:
        name = entity(kind, text[a:b])
        for low, high in ((_last_words(text, a), a), (b, _first_words(text, b))):
            for m in _TERM.finditer(text, low, high):
                s, e = m.span()
                cut = s == low and s > 0 and text[s - 1].isalnum() or e == high and e < len(text) and text[e].isalnum()
                i = bisect_left(starts, e)
                if not cut and (i == 0 or ends[i - 1] <= s):
                    out.append((name, m.group().lower(), s, e))
    return out


def _last_words(text: str, at: int) -> int:
    least = max(0, at - REACH_CHARS)
    for _ in range(REACH):
        while at > least and text[at - 1].isspace():
            at -= 1
        while at > least and not text[at - 1].isspace():
            at -= 1
    return at


def _first_words(text: str, at: int) -> int:
    n = min(len(text), at + REACH_CHARS)
    for _ in range(REACH):
        while at < n and text[at].isspace():
            at += 1
        while at < n and not text[at].isspace():
            at += 1
    return at


# ---------------------------------------------------------------------------
# Corpus statistics
# ---------------------------------------------------------------------------


def lower_bound(n: Column, of: Column) -> Column:
    """Wilson's lower confidence bound of a share of which ``n`` out of ``of`` were met."""
    p, z = n / of, Z * Z / of
    return (p + z / 2 - Z * F.sqrt(p * (1 - p) / of + z / (4 * of))) / (1 + z)


def _bound(n: int, of: int) -> float:
    """:func:`lower_bound` of numbers."""
    p, z = n / of, Z * Z / of
    return (p + z / 2 - Z * math.sqrt(p * (1 - p) / of + z / (4 * of))) / (1 + z)


def most_texts(n: int) -> int:
    """The most texts a term can be in that still discloses an entity near which it was met in ``n``; the bound falls with them."""
    of = n
    while _bound(n, of + 1) >= 2.0**-LEFT_GENERALISE * (1 - 1e-9):
        of += 1
    return of


#: A slot's byte is the number of texts up to FINE, beyond it FINE plus a power of two of them.
FINE = 127


def _digest(body: str) -> bytes:
    return xxhash.xxh128_digest(body.encode())


def scan(docs: DataFrame, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` with the pattern spans, counted by kind and in ``base``, the entities ``_names``, ``_near`` (entity, term
    and place of the terms near them) and the text's digest ``_key``. A map; no shuffle."""
    keep = carried(docs, COUNTS + ("base", "terms"), columns)
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
                       + [f"{m} long" for m in COUNTS] + [f"base {_SPAN}", "_names array<string>", f"_near {_NEAR}", "_key binary"])
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    near_type = pa.list_(pa.struct([("e", pa.string()), ("t", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in slices(batches):
            counts, base, names, near, key = [[] for _ in COUNTS], [], [], [], []
            for t in batch.column(batch.num_columns - 1):
                body = t.as_py() or ""
                spans = base_spans(body)
                kinds = Counter(s[0] for s in spans)
                for k, c in enumerate(counts):
                    c.append(kinds[KINDS[k]])
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                names.append(list({entity(k, body[a:b]) for k, a, b in spans}))
                near.append([{"e": e, "t": w, "start": a, "end": b} for e, w, a, b in surroundings(body, spans)])
                key.append(_digest(body))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(c, pa.int64()) for c in counts], pa.array(base, span_type),
                 pa.array(names, pa.list_(pa.string())), pa.array(near, near_type), pa.array(key, pa.binary())],
                names=[*keep, *COUNTS, "base", "_names", "_near", "_key"])

    return source.mapInArrow(run, schema)


def encounters(found: DataFrame) -> DataFrame:
    """Each term near an entity once for each different text: ``_key``, ``e``, ``t``, ``start``, ``end``."""
    return found.where(F.size("_near") > 0).select("_key", F.inline("_near")).distinct()


def _slot_table(pairs: DataFrame) -> bytes:
    """For each slot the number of texts to gather for terms of that slot (see FINE), 0 if it has none. The driver gets SLOTS bytes."""
    size = 1 << 12
    exact = [most_texts(n) for n in range(1, FINE // 4)]

    def pack(t: pa.Table) -> pa.Table:
        out = bytearray(size)
        for i, code in zip(t.column("slot").to_pylist(), t.column("code").to_pylist()):
            out[i % size] = code
        return pa.table({"block": t.column("block")[:1], "bytes": pa.array([bytes(out)], pa.binary())})

    slot = F.pmod(F.crc32(F.col("t").cast("binary")), F.lit(SLOTS)).cast("int")
    # beyond the exact ones, n / n_t, an upper bound of the share, allows for this many texts
    power = F.least(F.ceil(F.log2(F.col("n") * float(2**LEFT_GENERALISE))), F.lit(60)) + FINE
    code = F.coalesce(F.get(F.array(*map(F.lit, exact)), (F.col("n") - 1).cast("int")), power).cast("int")
    slots = pairs.select(slot.alias("slot"), code.alias("code")).groupBy("slot").agg(F.max("code").alias("code"))
    packed = slots.withColumn("block", F.floor(F.col("slot") / size).cast("int")).groupBy("block").applyInArrow(pack, "block int, bytes binary")
    table = bytearray(SLOTS)
    for block, data in packed.collect():
        table[block * size: (block + 1) * size] = data
    return bytes(table)


def term_texts(docs: DataFrame, slots: bytes, text: str = "text") -> DataFrame:
    """``t`` and ``n_t``, the number of different texts with the term, of the terms that ``slots`` asks for and that are
    in no more texts than it asks for (others may be missing). No text is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(slots)  # SLOTS bytes

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        table, room, met, held = shared.value, {}, {}, 0

        def rows() -> pa.RecordBatch:
            flat = [(t, k) for t, keys in met.items() for k in keys or (None,)]
            return pa.RecordBatch.from_arrays([pa.array([t for t, _ in flat], pa.string()), pa.array([k for _, k in flat], pa.binary())], names=["t", "k"])

        for batch in batches:
            for t in batch.column(0):
                body = t.as_py()
                key = None
                for w in set(_TERM.findall(body)):
                    most = room.get(w)
                    if most is None:
                        if len(room) > FLUSH:
                            room = {}
                        code = table[crc32(w.lower().encode()) % SLOTS]
                        most = room[w] = code if code <= FINE else 1 << code - FINE
                    if not most:
                        continue
                    key = key or _digest(body)
                    name = w.lower()
                    keys = met.setdefault(name, set())
                    if keys is None or key in keys:
                        continue
                    if len(keys) < most:
                        keys.add(key)
                        held += 1
                    else:  # more texts than can matter: no matter which
                        held -= len(keys) - 1
                        met[name] = None
            if held > FLUSH:
                yield rows()
                met, held = {}, 0
        yield rows()

    texts = docs.select(whole_text(F.col(f"`{text}`")).alias("t"))
    each = texts.mapInArrow(run, "t string, k binary").distinct()
    counted = each.groupBy("t").agg(F.count("k").alias("n_t"), F.count_if(F.col("k").isNull()).alias("more"))
    return counted.where(F.col("more") == 0).select("t", "n_t")


def _salted(left: DataFrame, right: DataFrame, keys: list[str], by: Column, how: str = "inner") -> DataFrame:
    """Join on ``keys`` with the rows of ``left`` that share a key dealt to SALTS parts by ``by``; ``right`` (few rows a key) is copied to each."""
    a = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return a.join(b, [*keys, "_salt"], how).drop("_salt")


def disclosing_pairs(docs: DataFrame, found: DataFrame, near: DataFrame, text: str = "text") -> DataFrame:
    """``e``, ``t``, ``disclosure`` (the bound of ``p(e | t)``) of the pairs to be generalised or removed. ``found`` and ``near`` are written
    tables of :func:`scan` and :func:`encounters`. Actions: writes the pairs, reads SLOTS bytes and the number of texts."""
    once = near.select("_key", "e", "t").distinct()
    pairs = once.groupBy("e", "t").agg(F.count(F.lit(1)).alias("n"))
    # a term near entities in more texts than its nearest entity allows for is in more texts still: no need to count it
    seen = once.select("_key", "t").distinct().groupBy("t").agg(F.count(F.lit(1)).alias("seen"))
    pairs = materialize(_salted(pairs, seen, ["t"], F.col("e")).where(lower_bound(F.col("n"), F.greatest("n", "seen")) >= 2.0**-LEFT_GENERALISE)
                        .drop("seen"), "pii-pairs")
    texts = max(1, found.select("_key").distinct().count())
    of_t = materialize(term_texts(docs, _slot_table(pairs), text), "pii-terms")
    # a common term is near many entities, an entity near many terms: both joins are dealt by the other
    close = _salted(pairs, of_t, ["t"], F.col("e")).withColumn("disclosure", lower_bound(F.col("n"), F.col("n_t")))
    close = close.where(F.col("disclosure") >= 2.0**-LEFT_GENERALISE)
    of_e = found.where(F.size("_names") > 0).select("_key", F.explode("_names").alias("e")).distinct().groupBy("e").agg(F.count(F.lit(1)).alias("n_e"))
    told = _salted(close, of_e, ["e"], F.col("t"))
    left = -F.log2("disclosure")
    learned = -F.log2(F.col("n_e") / texts) - left
    return told.where(learned >= TIMES * left + LEARNED).select("e", "t", "disclosure")


# ---------------------------------------------------------------------------
# Spans and texts
# ---------------------------------------------------------------------------


def find_spans(docs: DataFrame, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default all) with ``n_email``, ``n_ip``,
    ``n_card``, ``n_phone``, ``base`` (pattern spans) and ``terms`` (spans of
    disclosing terms with ``disclosure``, null where there are none). Input columns of these names
    are replaced. Actions: writes the rows with their pattern spans, the encounters, the disclosing pairs, and counts."""
    found = materialize(scan(docs, text, columns), "pii-found")
    near = materialize(encounters(found), "pii-near")
    risky = materialize(disclosing_pairs(docs, found, near, text), "pii-disclosing")
    kept = [F.col(f"`{c}`") for c in [*carried(docs, COUNTS + ("base", "terms"), columns), *COUNTS, "base"]]
    # by text, as copies share their spans
    spans = _salted(near, risky, ["e", "t"], F.col("_key")).groupBy("_key", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    terms = spans.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    plain = found.where(F.size("_near") == 0).select(*kept, F.lit(None).cast(terms.schema["terms"].dataType).alias("terms"))
    rows = found.where(F.size("_near") > 0).withColumn("_row", F.monotonically_increasing_id())
    return plain.unionByName(_salted(rows, terms, ["_key"], F.col("_row"), "left").select(*kept, "terms"))


def _joined(base, terms=None):
    mark = lambda kind, s: F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))
    parts = F.transform(base, lambda s: mark(s["kind"], s))
    if terms is not None:
        more = F.transform(terms, lambda s: mark(F.lit("term"), s))
        parts = F.concat(parts, F.coalesce(more, F.array().cast("array<string>")))
    return F.array_join(parts, ",")


def span_digests(found: DataFrame, keep: list[str]) -> DataFrame:
    """Counts, ``base_sha256`` and ``spans`` in the form kind:start:end."""
    return found.select(*[F.col(f"`{c}`") for c in keep], "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.col("base"), F.col("terms")).alias("spans"))


def general(term: str) -> str:
    """What kind of word a generalised term is."""
    if any(c.isdigit() for c in term):
        return "[NUMBER]"
    return "[NAME]" if term[:1].isupper() else "[WORD]"


def sanitise(text: str, base: list, terms: list | None) -> str:
    """The text without its entities and disclosing terms: entities become their
    kind, terms are removed or generalised."""
    spans = [(s["start"], s["end"], f"[{s['kind'].upper()}]") for s in base]
    for s in terms or ():
        word = text[s["start"]: s["end"]]
        spans.append((s["start"], s["end"], "[REMOVED]" if s["disclosure"] >= 2.0**-LEFT_REMOVE else general(word)))
    out, at = [], 0
    for a, b, marker in sorted(spans):
        if a >= at:
            out += [text[at:a], marker]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the sanitised text (a null text stays null)."""
    columns = carried(docs, ())
    made = find_spans(docs, text).select(*[F.col(f"`{c}`") for c in columns], "base", "terms")
    fields = made.schema.fields
    at = columns.index(text)

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in slices(batches):
            bodies, base, terms = (batch.column(i) for i in (at, len(columns), len(columns) + 1))
            out = [None if t is None else sanitise(t, b, s) if b else t
                   for t, b, s in zip(bodies.to_pylist(), base.to_pylist(), terms.to_pylist())]
            arrays = batch.columns[: len(columns)]
            arrays[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    schema = ", ".join(f"`{f.name}` {'string' if f.name == text else f.dataType.simpleString()}" for f in fields[: len(columns)])
    return made.withColumn(text, F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)
