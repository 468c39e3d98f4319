import zlib
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm.langid import fit_languages, label_languages, viterbi, word_scores, word_table
from tessera.llm.toxicity import crc_mod
from tests.llm.helpers import SF01, frame, no_documents, odd_documents, odd_rows


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(2)
    lengths = [0, 1, 6, 3, 5]
    offsets = np.cumsum([0, *lengths])
    scores, word = rng.normal(size=(7, 3)), rng.integers(0, 7, sum(lengths))
    path = viterbi(scores, word, offsets, 0.8)
    for d, n in enumerate(lengths):
        if n:
            w, got = word[offsets[d] : offsets[d + 1]], path[offsets[d] : offsets[d + 1]]
            value = lambda p: sum(scores[w[t], p[t]] for t in range(n)) - 0.8 * sum(p[t] != p[t - 1] for t in range(1, n))
            assert np.isclose(value(got), max(map(value, product(range(3), repeat=n))))


def test_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = fit_languages(docs, where=crc_mod(F.col("doc_id"), 3) != 1)
    found = {r.id: r for r in label_languages(docs, model).collect()}
    truth = dict(frame(SF01, "SELECT doc_id, lang FROM documents").itertuples(index=False))
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1]
    assert np.mean([found[d].lang_pred == truth[d] for d in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_spans_of_mixed_text_and_scripts(spark):
    rows = [("the cat and the dog sat on the mat with that thing", "en"), ("le chat et le chien sont dans la maison avec une pomme", "fr"),
            ("кот и собака сидят на ковре вместе", "ru"), ("η γάτα και ο σκύλος κάθονται", "el")] * 3
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"), penalty=3.0)
    text = "the dog sat on the mat le chien dans la maison кот и собака 12 ο σκύλος"
    r = label_languages(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [(s.lang, s.first_word, s.n_words) for s in r.spans][:3] == [("en", 0, 6), ("fr", 6, 5), ("ru", 11, 3)] and r.spans[-1].lang == "el"
    assert sum(s.n_words for s in r.spans) == len(text.split()) and r.lang_pred in ("en", "fr")


def test_scripts_narrow_the_candidates():
    table = word_table(pa.array(["cat", "кот", "12", "水"]))
    written = np.zeros((26, 2), bool)
    written[1, 0] = written[3, 1] = True  # Latin: the first language, Cyrillic: the second
    scores = word_scores(table, np.zeros((1 << 16, 2), np.float32), written, 1.0)
    assert scores[0, 0] > scores[0, 1] and scores[1, 1] > scores[1, 0] and (scores[2:] == 0).all()


def test_scripts_not_listed_and_rarely_used(spark):
    """Words of Oriya and Thaana letters, and of a script below the share, count by their letter runs."""
    latin = "the cat and the dog sat on the mat with that thing " * 20
    rows = [(latin, "en"), ("ଓଡ଼ିଆ ଭାଷା ଭାରତର ଏକ ପ୍ରାଚୀନ ଭାଷା ଅଟେ " * 20, "or"), ("ދިވެހި ބަސް ރާއްޖޭގެ ބަހެކެވެ " * 20, "dv"), (latin + "λόγος", "zz")]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    texts = spark.createDataFrame([(1, "ପ୍ରାଚୀନ ଭାଷା"), (2, "ދިވެހި ބަސް"), (3, "λόγος λόγος"), (4, "the dog 12")], "doc_id long, text string")
    found = {r.id: r.lang_pred for r in label_languages(texts, model).collect()}
    assert (found[1], found[2], found[3]) == ("or", "dv", "zz") and found[4] in ("en", "zz")


def test_odd_documents(spark):
    odd = odd_documents(spark)
    model = fit_languages(odd)
    found = label_languages(odd, model).collect()
    assert len(found) == len(odd_rows())
    for text in (None, "", " \t\n\x0b ", "12 34 !!! ..."):
        wanted = sum(t == text for _, t, *_ in odd_rows())
        assert wanted <= sum(r.lang_pred == "und" and r.score == 0 for r in found)
    assert sum(r.lang_pred == "und" for r in found) == sum(not any(c.isalpha() for c in t or "") for _, t, *_ in odd_rows())
    assert label_languages(no_documents(spark), model).count() == 0
    none = fit_languages(no_documents(spark))
    assert {(r.lang_pred, r.score) for r in label_languages(odd, none).collect()} == {("und", 0.0)}
