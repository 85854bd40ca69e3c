import pickle
import zlib
import zlib

import numpy as np

import __spark_entry__ as E
from ledgerflow.llm import lexicon as lx
from tests.conftest import SF_MID
from tests.llm.helpers import empty_docs, odd_docs

LABELS = "doc_id long, quality int, toxic int"
SF_BENCH = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def held_out(spark, sf):
    rows = E.queries()["op10_lexicon"](spark, sf).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    return rows, np.array([(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels])


def test_held_out_accuracy(spark):
    rows, x = held_out(spark, SF_BENCH)
    assert len(rows) == 10_000
    assert auc(x[:, 0], x[:, 1]) > 0.95
    right = (x[:, 0] >= 0.5) == (x[:, 1] == 1)
    assert right.mean() > 0.97 and right[x[:, 1] == 0].mean() > 0.99


def test_small_table(spark):
    rows, x = held_out(spark, SF_MID)
    assert len(rows) == 1000 and auc(x[:, 0], x[:, 1]) > 0.7


def test_folding():
    assert lx.fold("1D10T") == "idiot" and lx.fold("іdіоt") == "idiot" and lx.fold("ＩＤＩＯＴ") == "idiot" and lx.fold("ïdíòt") == "idiot"


def test_dollar_signs():
    assert lx.fold("$tupid") == "stupid" and lx.fold("trash$$$ x") == "trash$$$ x"


def test_beginnings_that_a_word_explains_go():
    got = lx.most_specific({"lose": 20, "loser": 20, "loser ": 20, "achl": 30, "achlich": 29, "achliche": 10, "achlicht ": 9})
    assert got == {"loser ", "achlich", "achliche", "achlicht "}


def model(weights, exceptions=()):
    return lx.Matcher(weights, exceptions)


def test_matching_equals_a_plain_search():
    rng = np.random.default_rng(1)
    weights = {"idiot ": 4.0, "idio": 2.0, "trash ": 3.0, "stup": 2.5, "stupid ": 5.0, "dumb ": 1.0}
    vocabulary = ["idiot", "idiotic", "trash", "trashy", "stupid", "stupor", "dumb", "dumbo", "fine", "can", "xidiot"]
    m = model(weights, ["trash can"])
    for _ in range(300):
        words = [str(w) for w in rng.choice(vocabulary, rng.integers(0, 12))]
        text = " ".join(words)
        want = 0.0
        for i, w in enumerate(words):
            if w == "trash" and words[i + 1:i + 2] == ["can"]:
                continue
            want += max([v for e, v in weights.items() if w + " " == e or (not e.endswith(" ") and w.startswith(e))], default=0.0)
        assert abs(sum(w for _, w in m.hits(text)) - want) < 1e-9, text


def test_exceptions_are_learnt(spark):
    rows, labels = [], []
    for i in range(400):
        toxic = i % 2
        filler = [f"w{chr(97 + (i * k) % 26)}{chr(97 + (i * 7 * k) % 26)}" for k in range(1, 20)]
        rows.append((i, " ".join([*filler[:9], "scumbag", *filler[9:]] if toxic else filler), "en", "s", 1))
        labels.append((i, 1, toxic))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, LABELS)
    m = lx.fit(docs, labels)
    assert any(e.strip().startswith("scum") for e in m.weights)
    score = pickle.loads(pickle.dumps(m)).scorer()
    assert score("you are a scumbag indeed") > 0.5 > score("you are a friend indeed") and score(None) < 0.5
    assert score("5CUMBАG you are") > 0.5  # digit and Cyrillic letter


def test_copies_of_one_document_teach_nothing(spark):
    """A toxic text with many copies: its ordinary words stay out."""
    rows = [(i, "plain ordinary phrase repeated by copies here", "en", "s", 1) for i in range(300)]
    rows += [(300 + i, f"text number {chr(97 + i % 26)} of clean words {chr(97 + i % 7)}", "en", "s", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(i < 300)) for i in range(900)], LABELS)
    assert lx.fit(docs, labels).weights == {}


def test_odd_rows_and_labels(spark):
    df = odd_docs(spark)
    none = lx.score_documents(df, spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 1, 7)], LABELS)).collect()
    assert len(none) == df.count() and {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(17)] + [(3, None, 0)], LABELS)
    some = lx.score_documents(df, labels).collect()
    assert len(some) == df.count() and all(0 <= r.score <= 1 for r in some)


def test_empty_tables(spark):
    labels = spark.createDataFrame([], LABELS)
    assert lx.score_documents(empty_docs(spark), labels).collect() == []
    assert lx.score_documents(empty_docs(spark), spark.createDataFrame([(1, 1, 1), (2, 1, 0)], LABELS)).collect() == []


def test_a_repeated_id_is_fitted_on_once(spark):
    """One toxic id on many rows of different texts teaches as one document."""
    word = lambda i, k: f"w{chr(97 + (i * k) % 26)}{chr(97 + (i * 7 * k + i // 26) % 26)}"
    rows, labels = [], []
    for i in range(400):
        filler = [word(i, k) for k in range(1, 20)]
        rows.append((i, " ".join([*filler[:9], "scumbag", *filler[9:]] if i % 2 else filler), "en", "s", 1))
        labels.append((i, 1, i % 2))
    again = next(i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5)
    rows += [(again, " ".join([*(word(i, k) for k in range(1, 10)), "marigold", word(i, 11)]), "en", "s", 1) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    weights = lx.fit(docs, spark.createDataFrame([*labels, (again, 1, 1)], LABELS)).weights
    assert any(e.strip().startswith("scum") for e in weights)
    assert not any(e.strip().startswith("mari") for e in weights)
