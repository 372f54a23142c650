import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import crc, documents, no_documents
from pyspark.sql import functions as F

from tidegauge.llm import language_model as lm
from tidegauge.llm.queries import op2_lm_scores
from tidegauge.llm.tables import fold, words

END = None


def tokens_of(text):
    return [*words(text), END]


class Plain:
    """The same model from dictionaries of n-grams, asked token by token."""

    def __init__(self, texts, order):
        self.order, self.counts = order, Counter()
        for text in texts:
            tokens = tokens_of(text)
            for n in range(1, order + 1):
                self.counts.update(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))
        self.total = sum(c for g, c in self.counts.items() if len(g) == 1)
        self.types = sum(len(g) == 1 for g in self.counts)

    def p(self, word, before):
        if not before:
            return (self.counts[word,] + 0.1) / (self.total + 0.1 * (self.types + 1))
        lower = self.p(word, before[1:])
        c = self.counts[before]
        if not c:
            return lower
        kept = lm.HEAPS_SCALE * c**lm.HEAPS_POWER
        return (self.counts[(*before, word)] + kept * lower) / (c + kept)

    def score(self, text):
        tokens = tokens_of(text)
        return sum(
            math.log10(self.p(w, tuple(tokens[max(0, i - self.order + 1) : i]))) for i, w in enumerate(tokens)
        )

    def row(self, text):
        tokens = tokens_of(text)
        return (
            len(tokens), sum(self.counts[t,] > 0 for t in tokens), self.total,
            pytest.approx(sum(math.log10(self.p(t, ())) for t in tokens)), pytest.approx(self.score(text)),
        )


def check(rows, given, order=2):
    plain = Plain([t for _, t, learn in given if learn], order)
    left = [(i, not learn, t) for i, t, learn in given]
    assert len(rows) == len(left)
    by_id = defaultdict(list)
    for i, held, text in left:
        by_id[i, held].append(plain.row(text))
    for r in rows:
        options = by_id[r.doc_id, r.held_out]
        at = next(k for k, o in enumerate(options) if tuple(r)[2:] == o)
        options.pop(at)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("block_bytes", [1 << 30, 2000])
def test_awkward_rows(spark, order, block_bytes):
    """Every order, and the corpus in one block or in many."""
    df = documents(spark)
    learning = (F.coalesce(F.col("doc_id"), F.lit(0)) % 3) != 1
    rows = lm.score_texts(df, learning, order=order, block_bytes=block_bytes).collect()
    given = [(r.doc_id, r.text, math.fmod(r.doc_id or 0, 3) != 1) for r in df.collect()]
    check(rows, given, order)


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = op2_lm_scores(spark, sf_dir).collect()
    check(rows, [(r.doc_id, r.text, crc(r.doc_id) % 10 != 0) for r in docs])
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.85 * sum(r.base_score for r in held)


def test_blocks_do_not_change_scores(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learning = fold("doc_id", 10) != 0
    one, many = ({r.doc_id: tuple(r)[:5] for r in lm.score_texts(docs, learning, block_bytes=b).collect()} for b in (1 << 30, 100_000))
    assert one == many


def test_probabilities_of_a_state_add_up():
    texts = ["a b a c", "b a c", "a a d"]
    plain = Plain(texts, 3)
    vocabulary = [g[0] for g in plain.counts if len(g) == 1] + ["never seen"]
    for state in [(), (b"a",), (b"b", b"a"), (b"x",), (b"a", b"a")]:
        assert sum(plain.p(w, state) for w in vocabulary) == pytest.approx(1)


def test_nothing_to_learn_and_no_rows(spark):
    rows = lm.score_texts(documents(spark), F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in rows} == {(0, 0)}
    assert all(r.score == pytest.approx(0) and r.base_score == pytest.approx(0) for r in rows)
    assert lm.score_texts(no_documents(spark), F.lit(True)).collect() == []


def test_rows_between_the_steps_grow_with_the_blocks(spark):
    """Four times the texts, and so four times the blocks, ask at most five times the rows."""
    rng = np.random.default_rng(3)

    def asked(n):
        rows = [(i, " ".join(rng.choice(["a", "b", "c", "d", "e"], 40)) + f" w{i}", True) for i in range(n)]
        blocks = lm.cut_blocks(spark.createDataFrame(rows, "doc_id long, text string, learning boolean").coalesce(1), 1000)
        return blocks.count(), lm.requests(blocks, 2).count()

    (few, small), (many, large) = asked(200), asked(800)
    assert 3.5 * few < many < 4.5 * few
    assert large < 5 * small


def test_copies_make_no_hot_block_or_range(spark):
    """One text in all rows: blocks keep their size, and each asks for its n-grams once."""
    rows = spark.range(2000).selectExpr("id AS doc_id", "'one two three two' AS text", "true AS learning")
    blocks = lm.cut_blocks(rows, 1000)
    assert max(r.n for r in blocks.select(F.size("ids").alias("n")).collect()) <= 60
    asked = Counter()
    for r in lm.requests(blocks, 2, 16).collect():
        asked[r.block] += len(lm.unpack_sorted(r.grams))
    assert set(asked.values()) == {4 + 4}


@pytest.mark.parametrize("order", [1, 2, 3])
def test_stretches_of_a_range_give_the_same(spark, sf_dir, order):
    """Ranges cut into stretches of about 50 n-grams, against ranges held whole."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learning = fold("doc_id", 10) != 0
    whole, cut = (
        {r.doc_id: tuple(r) for r in lm.score_texts(docs, learning, order=order, block_bytes=100_000, ranges=4, held=h).collect()}
        for h in (1 << 30, 50)
    )
    assert whole == cut


def test_a_counting_task_holds_a_stretch(spark, sf_dir):
    """Stretches stay near the bound however many n-grams a range has."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "true AS learning")
    blocks = lm.cut_blocks(docs, 100_000)
    held = Counter()
    for r in lm.in_stretches(lm.requests(blocks, 2, 4), 4, 4, 64).collect():
        held[r.part, r.stretch] += len(lm.unpack_sorted(r.grams))
    assert max(held.values()) < 3 * sum(held.values()) / 256


def test_numbers_pack_and_come_back():
    hashes = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 1000).astype("<u8") * 2)
    for part in (hashes, hashes[:1], hashes[:0]):
        assert (lm.unpack_sorted(lm.pack_sorted(part)) == part).all()
    for kind in ("?", "<i4", "<i8"):
        assert (lm.unpack(lm.pack((hashes % 2).astype(kind)), kind) == 0).all()
