import math
import random

import pytest
from cases import documents, no_documents
from tokenizers import Tokenizer, decoders, models

from tidegauge.llm import token_counts as tc
from tidegauge.llm.queries import op1_token_counts

SMALL = tc.pieces(["▁", "▁a", "b", "ab", "▁ab", "abc", "c", "a", "é", "bc", "▁abc"])


def plain_best(spelled, known):
    """The best segmentation by trying every piece at every place."""
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(spelled)
    for end in range(1, len(spelled) + 1):
        options = []
        for start in range(end):
            piece = spelled[start:end]
            if piece in known.scores:
                options.append((best[start][0] + known.scores[piece], best[start][1] - 1))
            elif end - start == 1:
                n = len(piece.encode("utf-8", "surrogatepass"))
                options.append((best[start][0] + n * known.byte, best[start][1] - n))
        best[end] = max(options)
    return -best[-1][1], best[-1][0]


@pytest.mark.parametrize("word", ["", "a", "abc", "abcabc", "xyz", "éa", "日本", "abc" * 100, "cab" * 99 + "é", "\ufeff", "▁a"])
def test_trie_equals_brute_force(word):
    given = {w.encode() for w in ("", "a", "ab", word, word[:3], word[:-1], word + "b", "zz", "aé")}
    found = tc.forward(SMALL, given)
    assert found.keys() == given
    for w, (tokens, score) in found.items():
        expected = plain_best(tc.WORD_START + w.decode(), SMALL)
        assert tokens == expected[0] and score == pytest.approx(expected[1])


def test_random_words_with_shared_prefixes():
    dice = random.Random(5)
    words = {"".join(dice.choices("abcé▁x", k=dice.randint(0, 9))).encode() for _ in range(3000)}
    for w, (tokens, score) in tc.forward(SMALL, words).items():
        expected = plain_best(tc.WORD_START + w.decode(), SMALL)
        assert tokens == expected[0] and score == pytest.approx(expected[1])


def test_shared_prefixes_are_scored_once():
    """Looks at a piece's endings once per node of the trie, not once per character."""

    class Counting(dict):
        asked = 0

        def get(self, key, *rest):
            Counting.asked += 1
            return super().get(key, *rest)

    known = SMALL._replace(tails=Counting(SMALL.tails))
    tc.forward(known, [b"abcabcabcabc"])
    alone = Counting.asked
    tc.forward(known, [b"abcabcabcabc", b"abcabcabcabd"])
    assert Counting.asked - alone < alone + 12


def test_what_is_kept_does_not_change_counts(monkeypatch):
    texts = [" ".join(f"{a}{b}abc" for a in "abcdé" for b in "xyzab"), None, "", "abc abc x"] * 3
    expected = list(tc.counted(SMALL, texts))
    assert [e[0] for e in expected[:4]] == [25, 0, 0, 3]
    for kept in (0, 5, 10**6):
        monkeypatch.setattr(tc, "MOST_KEPT", kept)
        for words in (1, 30):
            monkeypatch.setattr(tc, "WORDS_AT_ONCE", words)
            assert list(tc.counted(SMALL, texts)) == expected


def test_query_equals_a_unigram_tokenizer(spark, sf_dir):
    """The same vocabulary and scores in an independent unigram model, byte pieces included."""
    known = tc.load_pieces()
    vocab = [("<unk>", known.byte - 100), *known.scores.items(), *[(f"<0x{b:02X}>", known.byte) for b in range(256)]]
    model = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    model.decoder = decoders.ByteFallback()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    counts: dict[str, int] = {}
    rows = op1_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    off = 0
    for r in rows:
        words = texts[r.doc_id].encode().split()
        assert r.n_pretokens == len(words)
        for w in set(words) - counts.keys():
            counts[w] = len(model.encode(tc.WORD_START + w.decode()).ids)
        off += r.n_tokens != sum(counts[w] for w in words)
    # Sums of logarithms that are equal on paper may differ in their last bit.
    assert off <= len(rows) // 100


def test_awkward_rows(spark):
    df = documents(spark)
    rows = tc.count_tokens(df, SMALL).collect()
    assert len(rows) == df.count()
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in rows:
        if r.doc_id is None:
            continue
        best = [plain_best(tc.WORD_START + w.decode(), SMALL) for w in (texts[r.doc_id] or "").encode().split()]
        assert (r.n_pretokens, r.n_tokens) == (len(best), sum(n for n, _ in best))
        assert r.log_prob == pytest.approx(sum(s for _, s in best))
    assert tc.count_tokens(no_documents(spark), SMALL).collect() == []


def test_probabilities_of_pieces_add_up():
    known = tc.pieces(["a", "b", "c"])
    assert sum(map(math.exp, [*known.scores.values(), known.byte])) == pytest.approx(1)
