import random

from touchline.operators import patterns


def _found(spark, names, pats):
    texts = spark.createDataFrame(list(enumerate(names)), "tid long, name string")
    wanted = spark.createDataFrame(list(enumerate(pats)), "pid long, pattern string")
    return sorted(tuple(r) for r in patterns.matches(texts, "tid", "name", wanted, "pid", "pattern").collect())


def _brute(names, pats):
    return sorted(
        (t, p) for t, name in enumerate(names) for p, pat in enumerate(pats) if name is not None and pat and pat in name
    )


def test_prefix_patterns_find_longer_names(spark):
    names = ["NATION_1", "NATION_10", "NATION_2", "XNATION_19"]
    pats = ["NATION_1", "NATION_2"]
    assert _found(spark, names, pats) == _brute(names, pats)


def test_short_null_and_empty_patterns(spark):
    names = ["Rovers", "ab", None, "", "a", "Ärger FC"]
    pats = ["a", "ab", "", None, "Rov", "Ä", "zz"]
    assert _found(spark, names, pats) == _brute(names, pats)


def test_hot_gram_and_repeated_rows_match_brute_force(spark):
    rng = random.Random(7)
    letters = "abc "
    names = ["the " + "".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(400)] + ["the cab"] * 3
    pats = ["the", "the c", "ab", "cab", "b", "abc a", "the cab"] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(30)]
    assert _found(spark, names, pats) == _brute(names, pats)


def test_empty_tables(spark):
    assert _found(spark, [], ["abc"]) == []
    assert _found(spark, ["abc"], []) == []
