import math
import random

from pyspark.sql import functions as F

from touchline.operators import month_profile

SCHEMA = "day date, score double, team string"


def _rows(spark, seed, n, hot=None):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        month = hot if hot and i % 3 == 0 else rng.randint(1, 6)
        day = None if i % 97 == 0 else f"2024-{month:02d}-{rng.randint(1, 28):02d}"
        score = None if i % 11 == 0 else float(rng.randint(-50, 50)) / 4
        team = None if i % 13 == 0 else rng.choice(["Rovers", "United", "City", "Athletic"])
        data.append((day, score, team))
    return spark.createDataFrame(data, "day string, score double, team string").select(F.to_date("day").alias("day"), "score", "team")


def _profile(moments, values):
    return {r["column"]: r.asDict() for r in month_profile.merge(moments, values).collect()}


def _brute(rows):
    out = {}
    scores = [r.score for r in rows if r.score is not None]
    mean = sum(scores) / len(scores)
    std = math.sqrt(sum((s - mean) ** 2 for s in scores) / (len(scores) - 1))
    out["score"] = dict(rows=len(rows), missing=len(rows) - len(scores), count=len(scores), mean=mean, std=std, min=min(scores), max=max(scores))
    teams = [r.team for r in rows if r.team is not None]
    freq = {t: teams.count(t) for t in set(teams)}
    top = min(freq, key=lambda t: (-freq[t], t))
    out["team"] = dict(rows=len(rows), missing=len(rows) - len(teams), count=len(teams), unique=len(freq), top=top, freq=freq[top])
    return out


def _same(got, want):
    for column, fields in want.items():
        for key, value in fields.items():
            if isinstance(value, float):
                assert math.isclose(got[column][key], value, rel_tol=1e-9, abs_tol=1e-9), (column, key)
            else:
                assert got[column][key] == value, (column, key)


def test_merged_partials_equal_a_full_profile_with_a_hot_month(spark):
    df = _rows(spark, 1, 3000, hot=2)
    moments, values = month_profile.month_partials(df, F.date_format("day", "yyyy-MM"), ["score"], ["team"])
    got = _profile(moments, values)
    _same(got, _brute(df.collect()))
    exact = df.select(F.countDistinct("score")).first()[0]
    assert abs(got["score"]["approx_unique"] - exact) <= 0.05 * exact


def test_refresh_of_touched_months_equals_recompute_after_correction(spark):
    month = F.date_format("day", "yyyy-MM")
    before = _rows(spark, 2, 2000)
    stored = month_profile.month_partials(before, month, ["score"], ["team"])
    # A correction rewrites March and adds rows without a day; the other months are untouched.
    touched = ["2024-03", None]
    fresh_rows = _rows(spark, 3, 400).withColumn("day", F.when(F.col("day").isNull(), None).otherwise(F.lit("2024-03-05").cast("date")))
    after = before.where(~F.coalesce(month.isin("2024-03"), F.lit(False)) & F.col("day").isNotNull()).unionByName(fresh_rows)
    fresh = month_profile.month_partials(after.where(month.isin("2024-03") | F.col("day").isNull()), month, ["score"], ["team"])
    refreshed = [month_profile.refresh(s, f, touched) for s, f in zip(stored, fresh)]
    _same(_profile(*refreshed), _brute(after.collect()))


def test_nulls_single_values_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None, None), (None, 2.5, None)], SCHEMA)
    got = _profile(*month_profile.month_partials(df, F.date_format("day", "yyyy-MM"), ["score"], ["team"]))
    assert got["score"]["count"] == 1 and got["score"]["std"] is None and got["score"]["mean"] == 2.5
    assert got["team"] == dict(got["team"], rows=2, missing=2, count=0, unique=0, top=None, freq=None)
    empty = spark.createDataFrame([], SCHEMA)
    assert month_profile.merge(*month_profile.month_partials(empty, F.date_format("day", "yyyy-MM"), ["score"], ["team"])).count() == 0
