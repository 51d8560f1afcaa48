import random

import pytest
from pyspark.sql import functions as F

import scorers
from quadrat.functions import similarity
from quadrat.model import REGION_TYPES
from quadrat.operators import resolve

VOCAB = [
    ("dataset", "u:1", "North Coast"),
    ("dataset", "u:2", "South Coast"),
    ("dataset", "u:4", "Twin"),
    ("dataset", "u:3", "Twin"),
    ("region", "u:9", "North Coast"),
]


def resolved(spark, pairs, **more):
    vocab = spark.createDataFrame(VOCAB, "facet string, uri string, label string")
    asked = spark.createDataFrame(pairs, "facet string, value string")
    return {
        (r["facet"], r["value"]): (r["uri"], r["label"], r["outcome"])
        for r in resolve.resolve(asked, vocab, **more).collect()
    }


@pytest.mark.parametrize("rounds", [(), (92.0, 84.0)])
def test_resolve_outcomes(spark, rounds):
    got = resolved(
        spark,
        [
            ("dataset", " u:1 "),
            ("dataset", "South Coast"),
            ("dataset", "North coasy"),
            ("region", "North coasy"),
            ("dataset", "Twin"),
            ("dataset", "something else"),
            ("dataset", ""),
            ("project", "North Coast"),
        ],
        rounds=rounds,
    )
    assert got == {
        ("dataset", "u:1"): ("u:1", "North Coast", "uri"),
        ("dataset", "South Coast"): ("u:2", "South Coast", "label"),
        ("dataset", "North coasy"): ("u:1", "North Coast", "fuzzy"),
        ("region", "North coasy"): ("u:9", "North Coast", "fuzzy"),
        ("dataset", "Twin"): ("u:3", "Twin", "label"),
        ("dataset", "something else"): (None, None, "unmatched"),
        ("dataset", ""): (None, None, "unmatched"),
        ("project", "North Coast"): (None, None, "unmatched"),
    }


def test_resolve_is_idempotent(spark):
    first = resolved(spark, [("dataset", "Nrth Coast"), ("dataset", "Twin")])
    again = resolved(spark, [("dataset", v[1]) for v in first.values()])
    assert {v[0] for v in first.values()} == {v[0] for v in again.values()}


@pytest.mark.parametrize("threshold", [60, 75, 90])
def test_similar_pairs_loses_nothing(spark, threshold):
    """The filtered join finds exactly the pairs that scoring every pair finds."""
    rnd = random.Random(threshold)

    def word():
        return "".join(rnd.choice("aabbcde-é") for _ in range(rnd.randint(1, 14)))

    labels = sorted({word() for _ in range(120)})
    values = sorted({word() for _ in range(60)} | {w[:2] + w[3:] for w in labels[:40]} - {""})
    want = {
        (v, w): scorers.ratio(v, w)
        for v in values
        for w in labels
        if scorers.ratio(v, w) >= threshold
    }
    left = spark.createDataFrame([("x", v) for v in values], "facet string, value string")
    right = spark.createDataFrame([("x", w) for w in labels], "facet string, label string")
    rows = resolve.similar_pairs(left, right, threshold).collect()
    assert len(rows) == len({(r["value"], r["label"]) for r in rows})
    assert {(r["value"], r["label"]): r["score"] for r in rows} == pytest.approx(want)
    assert want
    for rounds in ((), resolve.ROUNDS):
        found = resolve.best_matches(left, right, threshold, rounds).collect()
        best = {r["value"]: (r["label"], r["score"]) for r in found}
        for v in values:
            mine = sorted((-s, w) for (x, w), s in want.items() if x == v)
            assert best.get(v) == ((mine[0][1], -mine[0][0]) if mine else None)


def test_shared_prefix_labels(spark):
    """Labels that differ in their numbers only: the hot characters come last."""
    labels = [f"Customer#{i:09d}" for i in range(0, 300, 7)]
    values = ["Customer#00000014", "Customr#000000021"]
    left = spark.createDataFrame([("x", v) for v in values], "facet string, value string")
    right = spark.createDataFrame([("x", w) for w in labels], "facet string, label string")
    found = resolve.best_matches(left, right, 75)
    got = {r["value"]: r["score"] for r in found.collect()}
    for v in values:
        assert got[v] == pytest.approx(max(scorers.ratio(v, w) for w in labels))


def test_resolve_single_corrects_addresses(spark):
    vocab = spark.createDataFrame(
        [("d", "http://v.test/abcdef", "Alpha"), ("d", "http://v.test/uvwxyz", "Omega")],
        "facet string, uri string, label string",
    )
    typed = ["http://v.test/abcdxf", "http://q", "Alpa", "http://v.test/uvwxyz", "Alp"]
    asked = spark.createDataFrame([("d", v) for v in typed], "facet string, value string")
    got = {r["value"]: (r["label"], r["outcome"]) for r in resolve.resolve_single(asked, vocab).collect()}
    assert got == {
        "http://v.test/abcdxf": ("Alpha", "fuzzy"),
        "http://q": (None, "unmatched"),
        "Alpa": ("Alpha", "fuzzy"),
        "http://v.test/uvwxyz": ("Omega", "uri"),
        "Alp": (None, "unmatched"),
    }


def test_match_species_against_brute_force(spark):
    names = ["Acacia aneura", "Acacia dealbata", "Eucalyptus camaldulensis", "Triodia basedowii", " "]
    df = spark.createDataFrame([(n,) for n in names for _ in range(3)], "scientific_name string")
    typed = ["ACACIA ANEURA", "acacia", "Eucalyptus camaldulensi", "basedowii Triodia", "zzz", ""]
    rows = resolve.match_species(df, "scientific_name", typed).orderBy("position").collect()
    for value, row in zip(typed, rows):
        exact = [n for n in names if n.casefold() == value.casefold() and value]
        scores = sorted((-scorers.weighted_ratio(value, n), n) for n in names if n.strip())
        want = exact[0] if exact else (scores[0][1] if -scores[0][0] >= 80 else None)
        assert row["speciesname"] == want, value
    assert rows[0]["score"] == 100 and rows[4]["speciesname"] is None


def test_region_types(spark):
    texts = {
        "Bioregions": "bioregions",
        "IBRA7 Subregions": "subregions",
        "local": "local-government-areas",
        REGION_TYPES["wwf-ecoregions"]: "wwf-ecoregions",
        REGION_TYPES["wwf-ecoregions"][:-1]: "wwf-ecoregions",
        "states": None,
        "http://elsewhere.test": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    got = {r["raw"]: r["region_type"] for r in resolve.resolve_region_types(df, "raw").collect()}
    assert got == texts


def test_resolve_name():
    allowed = ["dataset", "feature_type", "site_visit"]
    assert resolve.resolve_name("Feature Types", allowed) == "feature_type"
    assert resolve.resolve_name("visit", allowed) is None


def test_scorer_columns(spark):
    df = spark.createDataFrame([("ab", "ac"), (None, "x"), ("", "x")], "a string, b string")
    got = df.select(similarity.ratio_column("a", "b").alias("s")).collect()
    assert [r["s"] for r in got] == [50.0, None, 0.0]


def two_word_names(n, seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("aaabcdeeefghiiklmnoooprrsstttuvwy") for _ in range(rnd.randint(4, 11))) for _ in range(n)]
    return sorted({f"{rnd.choice(words)} {rnd.choice(words)}" for _ in range(n)})


def typos(names, n, seed):
    rnd, out = random.Random(seed), set()
    while len(out) < n:
        text = list(rnd.choice(names))
        for _ in range(rnd.randint(1, 3)):
            at = rnd.randrange(len(text))
            text[at : at + 1] = rnd.choice(["", "x", text[at] + "e"])
        out.add("".join(text))
    return sorted(out)


def test_few_pairs_meet(spark):
    """Two-word names and typos: a tenth of all pairs at most is joined, and none is lost."""
    names = two_word_names(600, 5)
    asked = typos(names, 200, 6)
    left = spark.createDataFrame([("x", v) for v in asked], "facet string, value string")
    right = spark.createDataFrame([("x", w) for w in names], "facet string, label string")
    met = resolve.key_pairs(resolve.sides_of(left, right), 75).distinct().count()
    assert met < len(names) * len(asked) / 10
    got = {(r["value"], r["label"]) for r in resolve.similar_pairs(left, right, 75).collect()}
    assert got == {(v, w) for v in asked for w in names if scorers.ratio(v, w) >= 75}


def test_ratio_without_python(spark):
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choices("abcdeé ñ\U0001d11e ", k=n))
    sizes = [(rnd.randint(0, 14), rnd.randint(0, 14)) for _ in range(300)]
    sizes += [(62, 62), (63, 63), (61, 130), (124, 125), (200, 186), (1100, 1010), (5, 1200)]
    rows = [(text(a), text(b)) for a, b in sizes] + [("a" * 200, "a" * 150)]
    df = spark.createDataFrame(rows, "a string, b string").repartition(4)
    scored = df.withColumn("s", similarity.ratio_column("a", "b"))
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    for r in scored.collect():
        assert r["s"] == pytest.approx(scorers.ratio(r["a"], r["b"])), (r["a"], r["b"])


def test_weighted_ratio_without_python(spark):
    rnd = random.Random(4)
    some = ["ab", "cd", "efg", "a", "zz\t", " x", "abcd"]
    text = lambda n: " ".join(rnd.choices(some, k=rnd.randint(0, n)))
    rows = [(text(4), text(7)) for _ in range(300)] + [("abcdefg" * 10, "bcd")]
    df = spark.createDataFrame(rows, "a string, b string").repartition(4)
    scored = df.withColumn("s", similarity.weighted_ratio_column("a", "b"))
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    for r in scored.collect():
        assert r["s"] == pytest.approx(scorers.weighted_ratio(r["a"], r["b"])), (r["a"], r["b"])


def test_few_species_are_scored(spark):
    """All names that reach the threshold are among the scored ones, and most others are not."""
    names = two_word_names(300, 9) + ["aa aa bb", "a\tb c", "bb"]
    asked = typos(names, 12, 3) + ["aa bb", "c b a", "acacia"]
    df = spark.createDataFrame([(n,) for n in names], "speciesname string")
    typed = spark.createDataFrame(list(enumerate(asked)), "position int, value string")
    scored = {(r["value"], r["speciesname"]) for r in resolve.species_candidates(df, typed, 80).collect()}
    want = {(v, n) for v in asked for n in names if scorers.weighted_ratio(v, n) >= 80}
    assert want <= scored and len(scored) < len(names) * len(asked) / 10


def test_resolve_name_ratio():
    rnd = random.Random(1)
    for _ in range(100):
        a, b = ("".join(rnd.choices("abc", k=rnd.randint(0, 9))) for _ in "ab")
        assert similarity.ratio(a, b) == pytest.approx(scorers.ratio(a, b))
