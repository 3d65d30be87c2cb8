"""Encoding against the tokenizers library, counts against a plain Viterbi search."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from linetally.llm import bpe, common, tokens
from linetally.llm.pretokens import Splitter, load_vocabulary, split_patterns

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "the the", "<|endoftext|>x<|endoftext|>", "it's 12ab  \n\n x", "naïve — 🙂🙂 ﷽", "\x1c\x85　 x",
         "aaaa" * 50, "x" * 5000, "�\x00"]


def test_same_cuts_as_the_library_for_every_code_point():
    split, own = Tokenizer.from_file(PATH).pre_tokenizer, Splitter(split_patterns())
    for base in range(0, 0x110000, 1024):
        text = "".join(f"a1!{chr(c)}a1 {chr(c)}" for c in range(base, base + 1024) if not 0xD800 <= c < 0xE000)
        assert [text[i:j] for _, (i, j) in split.pre_tokenize_str(text)] == own(text)


def test_ids_equal_the_library_on_random_strings():
    lib, own = Tokenizer.from_file(PATH), bpe.Encoder(PATH, split_patterns())
    rnd = random.Random(3)
    vocab = list(load_vocabulary(PATH)[0])
    for _ in range(3000):
        text = b"".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 8))).decode("utf-8", "replace")
        ids = lib.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_encode_texts_on_odd_rows_with_clashing_columns(spark):
    lib = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens long")
    got = {r["doc_id"]: r for r in bpe.encode_texts(df, PATH).collect()}
    for i, t in enumerate(TEXTS):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert (got[i]["ids"], got[i]["n_tokens"]) == (ids, len(ids))
        assert got[i]["decoded"] == lib.decode(ids, skip_special_tokens=False)
    assert bpe.encode_texts(df.limit(0), PATH).count() == 0


def _viterbi(word, scores):
    best = [(0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            s = scores.get(word[start:end])
            if s is not None and best[start] is not None:
                c = (best[start][0] + s, best[start][1] - 1)
                best[end] = c if best[end] is None else max(best[end], c)
    return -best[-1][1]


def test_token_counts_equal_a_search_per_word(spark):
    scores = tokens.rank_scores(load_vocabulary(PATH)[0])
    split = Splitter(split_patterns())
    texts = [t if t is None else t[:60] for t in TEXTS]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in tokens.count_tokens(df, PATH).collect()}
    for i, t in enumerate(texts):
        pieces = split(t or "")
        assert got[i] == (len(pieces), sum(_viterbi(p.encode(), scores) for p in pieces))
    assert tokens.count_tokens(df.limit(0), PATH).count() == 0


def test_worker_holds_tables_of_one_operator():
    made = []
    make = lambda x: lambda: made.append(x) or [x]
    assert common.worker_table(("a", 1), make(1)) is common.worker_table(("a", 1), make(2))
    assert common.worker_table(("b", 1), make(3)) == [3] and list(common._tables) == [("b", 1)]
    common.release_tables()
    assert not common._tables and common.worker_table(("a", 1), make(4)) == [4] and made == [1, 3, 4]
    common.release_tables()
