import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from lagscope.llm import language, queries


def symbols(text):
    found = [int(language.SYMBOL[b]) for b in text.lower().encode()]
    return [s for i, s in enumerate(found) if s or i == 0 or found[i - 1]]


def plain_bits(lessons, text):
    """Code length under one tree: counts of every context, escapes as in method C."""
    paths = Counter()
    for lesson in lessons:
        own = [0] * language.ORDER + symbols(lesson)
        paths.update(tuple(own[i : i + language.ORDER + 1]) for i in range(len(own) - language.ORDER))
    trees = [defaultdict(Counter) for _ in range(language.ORDER + 1)]
    for path, n in paths.items():
        if n >= language.LEAST_SEEN:
            for depth in range(language.ORDER + 1):
                trees[depth][path[language.ORDER - depth : -1]][path[-1]] += n
    own, bits = [0] * language.ORDER + symbols(text), 0.0
    for i in range(language.ORDER, len(own)):
        cost = None
        for depth in range(language.ORDER, -1, -1):
            seen = trees[depth][tuple(own[i - depth : i])]
            whole = sum(seen.values()) + len(seen)
            if own[i] in seen:
                cost = math.log2(whole / seen[own[i]])
            elif seen:
                bits += math.log2(whole / len(seen))
            if cost is not None:
                break
        bits += language.BITS if cost is None else cost
    return bits


LESSONS = {
    "de": ["der die und das ist nicht ein eine über straße", "und der hund ist nicht das haus und die straße"],
    "en": ["the and that is not a house over the street", "and the dog is not the house, and that street"],
    "fr": ["le et la est pas une maison sur la rue été", "et le chien est pas la maison et la rue"],
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(lang, t) for lang, own in LESSONS.items() for t in own]
    return language.fit_trees(spark.createDataFrame(rows, "lang string, text string"))


def test_code_lengths_equal_a_plain_version(spark, model):
    texts = ["the dog and the house", "Der Hund, über das Haus", "la rue été!!", "zzz qqq", "x", "über 中文 the"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in language.predict_language(df, model).collect()}
    for i, t in enumerate(texts):
        bits = {lang: plain_bits(own, t) for lang, own in LESSONS.items()}
        best = min(bits.values())
        assert bits[rows[i]["lang_pred"]] - best < 1e-3
        assert np.isclose(rows[i]["score"], 1 / sum(2 ** (best - b) for b in bits.values()), atol=1e-4)


def test_texts_without_letters_are_unknown(spark, model):
    texts = [None, "", "  ", "123 !!", "#*$", "中", "é"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(language.predict_language(df, model).collect())
    assert [r["lang_pred"] == language.UNKNOWN for r in rows] == [True] * 5 + [False] * 2
    assert [r["score"] for r in rows[:5]] == [0.0] * 5


def test_held_out_accuracy(spark, larger_dir):
    docs = spark.read.parquet(f"{larger_dir}/documents.parquet").select("doc_id", "lang", "text")
    rows = queries.language_ppm(spark, larger_dir).join(docs, "doc_id").filter("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98


def test_odd_rows(odd, nothing, model):
    own = language.fit_trees(odd)
    assert own["langs"] == ["de", "en"]
    assert language.predict_language(odd, own).count() == odd.count()
    assert language.predict_language(nothing, own).count() == 0
    none = language.fit_trees(nothing)
    assert {r["lang_pred"] for r in language.predict_language(odd, none).collect()} == {language.UNKNOWN}


def test_each_language_keeps_its_share_of_paths(spark, monkeypatch):
    """A frequent language leaves room for a rare one, and a cut is said."""
    monkeypatch.setattr(language, "MOST_PATHS", 60)
    random = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrst")
    rows = [("xx", "".join(random.choice(letters, 400))) for _ in range(40)] + [("yy", "uvuvuvuv uvuv")] * 2
    df = spark.createDataFrame(rows, "lang string, text string")
    with pytest.warns(UserWarning, match="cut to the 30 most frequent paths each: xx"):
        model = language.fit_trees(df)
    sizes = {name: len(path) for name, (path, _) in model["trees"].items()}
    assert sizes["xx"] == 30 and 0 < sizes["yy"] <= 30


@pytest.mark.parametrize("most", [1, 60])
def test_paths_that_are_not_in_memory_count_all_the_same(spark, monkeypatch, most):
    """Code lengths are those of whole trees, however few of their paths are sent to the tasks,
    and no language is lost where there are more of them than such paths."""
    monkeypatch.setattr(language, "MOST_PATHS", most)
    texts = ["the dog and the house", "Der Hund, über das Haus", "la rue été!!", "zzz qqq", "x", "", None, "über 中文 the"]
    texts += ["et le chien est pas la maison " * 50_000]
    rows = [(lang, t) for lang, own in LESSONS.items() for t in own]
    with pytest.warns(UserWarning, match="cut to the"):
        model = language.fit_trees(spark.createDataFrame(rows, "lang string, text string"))
    assert model["langs"] == ["de", "en", "fr"]
    assert 0 < max(len(path) for path, _ in model["trees"].values()) <= max(most // 3, 1)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: r for r in language.predict_language(df, model).collect()}
    for i, t in enumerate(texts):
        if not t:
            assert (found[i]["lang_pred"], found[i]["score"]) == (language.UNKNOWN, 0.0)
            continue
        bits = {lang: plain_bits(own, t) for lang, own in LESSONS.items()}
        best = min(bits.values())
        assert bits[found[i]["lang_pred"]] - best < 1e-3
        assert np.isclose(found[i]["score"], 1 / sum(2 ** max(best - b, -1000) for b in bits.values()), atol=1e-4)
