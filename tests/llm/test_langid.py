import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import langid
from sparkloom.llm.langid import SCRIPTS, SWITCH_PENALTY, held_out, identify_languages, known_language, scripts_of, train

WORDS = {
    "en": "the of and house water green thing with from under little morning thought weather".split(),
    "de": "der die und haus wasser grün straße mit von unter kleine morgen gedanke wetter größe".split(),
    "ru": "и дом вода зелёный вещь с из под маленький утро мысль погода слово".split(),
}


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(3, 60))), lang, "s"))
    return out


def brute_viterbi(model, words):
    scores = model.scores[model.rows_of(words)].astype(float)
    best, back = np.zeros(len(model.languages)), []
    for s in scores:
        step = best[:, None] - SWITCH_PENALTY * (1 - np.eye(len(best)))
        back.append(step.argmax(axis=0))
        best = step.max(axis=0) + s
    return best.max()


def path_score(model, words, labels):
    scores = model.scores[model.rows_of(words)].astype(float)
    return sum(scores[i, l] for i, l in enumerate(labels)) - SWITCH_PENALTY * sum(a != b for a, b in zip(labels, labels[1:]))


def test_accuracy_on_held_out(spark):
    data = corpus()
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in identify_languages(df, train(df)).collect()}
    held = [d for d in data if found[d[0]].held_out]
    assert held and sum(found[d[0]].lang_pred == d[2] for d in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_spans_of_mixed_text_and_best_path(spark):
    model = train(spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string"))
    rng = random.Random(4)
    text = " ".join(rng.choices(WORDS["en"], k=12) + ["--"] + rng.choices(WORDS["ru"], k=9) + rng.choices(WORDS["de"], k=15))
    assert model.spans(text) == [(0, 13, "en"), (13, 22, "ru"), (22, 37, "de")]
    for seed in range(20):
        rng = random.Random(seed)
        words = [w for k in range(4) for w in rng.choices(WORDS[rng.choice(list(WORDS))], k=rng.randrange(1, 9))]
        (labels,) = model.label([" ".join(words)])
        assert abs(path_score(model, words, labels) - brute_viterbi(model, words)) < 1e-3


def test_edges(spark, docs, rows, empty):
    model = train(docs)
    found = identify_languages(docs, model).collect()
    assert len(found) == len(rows)
    for r in found:
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        has_letter = any(c.isalpha() for c in text or "")
        assert (r.lang_pred == "und") == (not has_letter)
        assert r.lang_pred in {"und", "en", "de", "fr"}
    assert identify_languages(empty, train(empty)).collect() == []
    assert {r.lang_pred for r in identify_languages(docs, train(empty)).collect()} == {"und"}
    kept = known_language(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(any(c.isalpha() for c in t or "") for _, t, *_ in rows)


def test_held_out_rows_are_not_learned_from(spark):
    data = corpus(120)
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    lied = df.withColumn("lang", __import__("pyspark.sql.functions", fromlist=["x"]).when(held_out(df.doc_id), "xx").otherwise(df.lang))
    assert train(lied).languages == sorted(WORDS)


def test_scripts():
    assert [SCRIPTS[i] for i in scripts_of(np.array([ord(c) for c in "aßжαש中あ한"]))] == ["Latin", "Latin", "Cyrillic", "Greek", "Hebrew", "Han", "Kana", "Hangul"]


def test_three_hundred_languages(spark):
    """Each language has words of its own letters in an order of its own; none is lost to the width of a number."""
    rng = random.Random(3)
    words = {f"l{k:03d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(12)] for k in range(300)}
    data = [(i, " ".join(rng.choices(words[lang], k=20)), lang) for i, lang in enumerate(sorted(words) * 4)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = train(df)
    assert len(model.languages) == 300
    found = {r.doc_id: r.lang_pred for r in identify_languages(df, model).collect()}
    learned = set(model.languages)
    assert "und" not in found.values()
    assert all(found[i] == lang for i, _, lang in data if lang in learned)
    text = " ".join(words["l299"] + words["l007"] + words["l200"])
    assert [name for _, _, name in model.spans(text)] == ["l299", "l007", "l200"]


def test_long_texts_take_the_same_path_in_bounded_memory(spark, monkeypatch):
    model = train(spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string"))
    rng = random.Random(9)
    text = " ".join(w for k in range(300) for w in rng.choices(WORDS[rng.choice(list(WORDS))], k=rng.randrange(1, 20)))
    (whole,) = model.label([text])
    for cells, long_text in ((50, langid.LONG_TEXT), (50, 100), (langid.CELLS, 100)):
        monkeypatch.setattr(langid, "CELLS", cells)
        monkeypatch.setattr(langid, "LONG_TEXT", long_text)
        monkeypatch.setattr(langid, "WORDS_AT_ONCE", 64)
        (found,) = model.label([text])
        assert (found == whole).all()
    assert [*map(len, model.label(["", None, " \n ", "x " * 100]))] == [0, 0, 0, 100]


@pytest.mark.parametrize("many", [8, 0])
def test_the_sample_is_the_rows_of_smallest_hash(spark, monkeypatch, many):
    monkeypatch.setattr(langid, "MANY_SAMPLES", many)
    known = spark.range(4000).select(F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("lang"), F.xxhash64("id").alias("h"))
    hashes = {}
    for r in known.collect():
        hashes.setdefault(r.lang, []).append(r.h)
    assert langid._sample_limits(known, 50) == {k: sorted(v)[49] for k, v in hashes.items()}
    assert langid._sample_limits(known, 2000) == {"a": sorted(hashes["a"])[1999], "b": max(hashes["b"])}


def test_a_language_is_no_task_of_its_own(spark):
    """A third of all rows and more have one language, many of them one id: what is shuffled are counts."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("the house").alias("text"), F.lit("en").alias("lang"))
    assert train(df).languages == ["en"]
