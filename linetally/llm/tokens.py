"""Token counts under a unigram vocabulary, by a dynamic program on a trie.

The best segmentation of a pre-token is the one with the greatest sum of
token scores. The forward score of a prefix depends on the prefix alone, so
the distinct pre-tokens are held as a trie and each node's score is computed
once for all pre-tokens that share the prefix; the number of tokens stored
at a terminal node is that pre-token's count, and a document's count is the
sum over its pre-tokens.

The trie is the sorted list of the distinct pre-tokens of an Arrow batch:
walking it in order is a depth-first walk, where a node's ancestors are the
cells of the current path and two neighbours share the nodes of their
common prefix. Counts of pre-tokens met before are kept in two tables (the younger and
the older) of bounded size. Rows are only mapped: no shuffle.

Scores are integers, so sums are exact in any order; of equally good
segmentations the one with fewer tokens counts. Every byte has a score, so
each text has a segmentation.

Results for odd input: null counts as empty text, which has no tokens; an empty
table gives an empty result; texts of any length are read whole; repeated rows
give repeated results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, whole_text, worker_table
from .pretokens import Splitter, load_vocabulary, split_patterns

CACHE_SIZE = 400_000
CACHE_LENGTH = 40
#: Texts whose pre-tokens are in memory at a time.
STEP = 500
#: Scores are this many times the natural logarithm of the probability.
SCALE = 1_000_000


def rank_scores(vocab: dict[bytes, int]) -> dict[bytes, int]:
    """Scores for a vocabulary file that has none: the probability of a token
    is taken to be inversely proportional to its rank plus one (Zipf's law)."""
    total = math.log(sum(1 / (i + 1) for i in vocab.values()))
    return {b: round(SCALE * (-math.log(i + 1) - total)) for b, i in vocab.items()}


class TrieCounter:
    def __init__(self, scores: dict[bytes, int]):
        self.scores = scores
        self.longest = max(map(len, scores))
        #: token lengths by last byte, so that only lengths that occur are tried
        lengths: dict[int, set[int]] = {}
        for b in scores:
            lengths.setdefault(b[-1], set()).add(len(b))
        self.lengths = {k: sorted(v) for k, v in lengths.items()}
        self.counts: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    def count_all(self, pieces: set[bytes]) -> dict[bytes, int]:
        """Token count of each pre-token: one walk over their trie."""
        best, n = [0], [0]  # forward score and tokens of each prefix on the current path
        out, before, scores, lengths = {}, b"", self.scores, self.lengths
        for piece in sorted(pieces):
            shared, limit = 0, min(len(before), len(piece))
            while shared < limit and before[shared] == piece[shared]:
                shared += 1
            del best[shared + 1:], n[shared + 1:]
            for end in range(shared + 1, len(piece) + 1):
                top, few = None, 0
                for size in lengths[piece[end - 1]]:
                    if size > end:
                        break
                    s = scores.get(piece[end - size: end])
                    if s is not None:
                        s += best[end - size]
                        k = n[end - size] + 1
                        if top is None or s > top or s == top and k < few:
                            top, few = s, k
                best.append(top)
                n.append(few)
            out[piece] = n[-1]
            before = piece
        return out

    def count_texts(self, pieces_of: list[list[bytes]]) -> list[int]:
        """Token counts of texts given as lists of pre-tokens."""
        known, older = self.counts, self.older
        new = {p for pieces in pieces_of for p in pieces if p not in known}
        found = {p: older[p] for p in new if p in older}
        found |= self.count_all(new - found.keys())
        known |= found
        totals = [sum(map(known.__getitem__, pieces)) for pieces in pieces_of]
        for p in found:
            if len(p) > CACHE_LENGTH:
                del known[p]
        if len(known) > CACHE_SIZE:
            self.older, self.counts = known, {}
        return totals


def counter(path: str) -> TrieCounter:
    return worker_table(("unigram", path), lambda: TrieCounter(rank_scores(load_vocabulary(path)[0])))


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_pretokens`` and ``n_tokens`` (input columns of these
    names are replaced)."""
    made = ["n_pretokens", "n_tokens"]
    keep = carried(docs, made)
    source = docs.select(*[F.col(f"`{c}`") for c in keep], whole_text(text).alias("_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
                       + [f"{m} bigint" for m in made])
    patterns = split_patterns()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, count = Splitter(patterns), counter(path)
        for batch in batches:
            pieces, totals = [], []
            for start in range(0, batch.num_rows, STEP):
                texts = batch.column(batch.num_columns - 1)[start: start + STEP].to_pylist()
                part = [[p.encode() for p in split(t)] for t in texts]
                pieces += map(len, part)
                totals += count.count_texts(part)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(pieces, pa.int64()), pa.array(totals, pa.int64())], names=[*keep, *made])

    return source.mapInArrow(run, schema)

