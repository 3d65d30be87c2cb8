"""BPE encoding by a dynamic program over prefixes, and decoding.

For every prefix of a pre-token there is exactly one token that ends the BPE
encoding of that prefix. It is found without merging: the automaton of all
token strings (Aho-Corasick) names the tokens that are suffixes of the
prefix, and a token ``t`` is the right one if it is compatible with the last
token ``p`` of the prefix before it, that is, if encoding the two strings
together gives ``p, t`` again. Following the stored last tokens back from
the end gives the ids. The work is linear in the text, for words of any
length.

Compatibility of two neighbours is decided from merge ranks alone. While
the left token is built, its last part grows along a chain of merges (the
right spine), and the first part of the right token grows along its left
spine; walking both chains in the order of their ranks shows each pair of
parts that ever meets at the boundary. If one of these pairs would merge
before its parts are taken up by their own token, the two tokens cannot stand
side by side.

Encoding runs as an Arrow map over the rows: no shuffle; the vocabulary is
read from a file that every executor has. A worker keeps the results of
short pre-tokens in a table of bounded size.

Results for odd input: null counts as empty text, which has no ids and
decodes to the empty text; texts of any length are encoded whole; repeated
rows give repeated results; the text of an added token becomes its id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, returning_memory, slices, whole_text, worker_table
from .pretokens import Splitter, load_vocabulary, split_patterns

#: Pre-tokens kept in each of a worker's two tables, and the longest of them in characters.
CACHE_SIZE = 100_000
CACHE_LENGTH = 40
#: Pairs of tokens whose compatibility a worker remembers.
MAX_PAIRS = 500_000
NEVER = 1 << 60


class Encoder:
    def __init__(self, path: str, split: tuple[str, str]):
        vocab, merges, added = load_vocabulary(path)
        self.vocab, self.added = vocab, added
        self.token_bytes = {i: b for b, i in vocab.items()} | {i: s.encode() for s, i in added.items()}
        #: of each token that a merge makes: rank of the merge and its parts
        self.made = {}
        self.rank = {}
        for r, (a, b) in enumerate(merges):
            self.rank[vocab[a], vocab[b]] = r
            self.made.setdefault(vocab[a + b], (r, vocab[a], vocab[b]))
        self.spines: tuple[dict, dict] = {}, {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for b, i in vocab.items():
            if len(b) == 1 or i in self.made:
                self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        self.added_pattern = re.compile("|".join(re.escape(s) for s in sorted(added, key=len, reverse=True))) if added else None
        self.split = Splitter(split)
        #: results of pre-tokens in two generations; the older one goes when the younger is full
        self.cache: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}

    def spine(self, token: int, side: int) -> tuple[list[int], list[int]]:
        """Parts of a token at its left (side 0) or right (1) end, smallest
        first, with the rank at which each is taken up by the next."""
        found = self.spines[side].get(token)
        if found is None:
            parts, taken = [token], [NEVER]
            while parts[-1] in self.made:
                r, *halves = self.made[parts[-1]]
                parts.append(halves[side])
                taken.append(r)
            found = self.spines[side][token] = parts[::-1], taken[::-1]
        return found

    def compatible(self, left: int, right: int) -> bool:
        (xs, x_end), (ys, y_end) = self.spine(left, 1), self.spine(right, 0)
        i = j = 0
        while True:
            r = self.rank.get((xs[i], ys[j]), NEVER)
            # of equal merges the one further left comes first
            if r < x_end[i] and r <= y_end[j]:
                return False
            if i == len(xs) - 1 and j == len(ys) - 1:
                return True
            if x_end[i] <= y_end[j] and i < len(xs) - 1:
                i += 1
            else:
                j += 1

    def encode_bytes(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        last, start_of, pairs = [-1] * (len(word) + 1), [0] * (len(word) + 1), self.pairs
        done = -1
        for end, (token, size) in self.automaton.iter(word.decode("latin-1")):
            if end == done:
                continue
            start = end + 1 - size
            if start:
                key = last[start] << 20 | token
                ok = pairs.get(key)
                if ok is None:
                    if len(pairs) > MAX_PAIRS:
                        pairs.clear()
                    ok = pairs[key] = self.compatible(last[start], token)
                if not ok:
                    continue
            done = end
            last[end + 1], start_of[end + 1] = token, start
        ids, at = [], len(word)
        while at:
            ids.append(last[at])
            at = start_of[at]
        return ids[::-1]

    def entry(self, piece: str) -> tuple[int, str, bytes]:
        """Number of ids, the ids as text, and the bytes they decode to."""
        e = self.older.get(piece)
        if e is None:
            ids = self.encode_bytes(piece.encode())
            e = len(ids), ",".join(map(str, ids)), b"".join([self.token_bytes[i] for i in ids])
        if len(piece) <= CACHE_LENGTH:
            if len(self.cache) >= CACHE_SIZE:
                self.older, self.cache = self.cache, {}
            self.cache[piece] = e
        return e

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """Stretches of text between added tokens, and the added tokens (True)."""
        at = 0
        for m in self.added_pattern.finditer(text) if self.added_pattern else ():
            yield False, text[at: m.start()]
            yield True, m.group()
            at = m.end()
        yield False, text[at:]

    def encode_parts(self, text: str) -> list[tuple[int, str, bytes]]:
        out = []
        for is_added, piece in self.pieces(text):
            if is_added:
                out.append((1, str(self.added[piece]), piece.encode()))
            else:
                get, entry = self.cache.get, self.entry
                out += [get(p) or entry(p) for p in self.split(piece)]
        return out

    def encode(self, text: str) -> list[int]:
        return [int(x) for _, ids, _ in self.encode_parts(text) for x in ids.split(",")]

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.token_bytes[i] for i in ids]).decode("utf-8", "replace")


def encoder(path: str, split: tuple[str, str]) -> Encoder:
    return worker_table(("bpe", path, split), lambda: Encoder(path, split))


def encode_texts(docs: DataFrame, path: str, text: str = "text", ids: bool = True, digests: bool = False,
                 columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default all) with ``n_tokens`` and, as asked, ``ids`` (array of int) and
    ``decoded`` (the text decoded from the ids), or their digests:
    ``ids_sha256`` (of the decimal ids joined by commas) and
    ``decoded_sha256`` (of the decoded text in UTF-8). Input columns of these
    names are replaced."""
    made = ["n_tokens", *(["ids", "decoded"] if ids else []), *(["ids_sha256", "decoded_sha256"] if digests else [])]
    keep = carried(docs, made, columns)
    types = {"n_tokens": "bigint", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}
    source = docs.select(*[F.col(f"`{c}`") for c in keep], whole_text(text).alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
                       + [f"{m} {types[m]}" for m in made])

    split = split_patterns()

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, split)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in slices(batches):
            out = {m: [] for m in made}
            for t in batch.column(batch.num_columns - 1):
                parts = enc.encode_parts(t.as_py())
                out["n_tokens"].append(sum([p[0] for p in parts]))
                listed = ",".join([p[1] for p in parts])
                decoded = b"".join([p[2] for p in parts]).decode("utf-8", "replace")
                if ids:
                    out["ids"].append([int(x) for x in listed.split(",")] if listed else [])
                    out["decoded"].append(decoded)
                if digests:
                    out["ids_sha256"].append(sha(listed.encode()))
                    out["decoded_sha256"].append(sha(decoded.encode()))
            arrow = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(out[m], arrow.get(m, pa.string())) for m in made]],
                names=[*keep, *made])

    return source.mapInArrow(run, schema)
