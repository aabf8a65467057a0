"""Scores of whole candidate lists against vectors that are too many to
broadcast, their metrics, and shuffle files that end with the write."""

import glob

import pytest
from pyspark.sql import functions as F

from recprep.operators import list_scoring, scoring
from recprep.operators.metrics import ranking_metrics, ranking_metrics_arrays
from recprep.operators.scoring import score_candidates
from recprep.plans.evaluation import _ranked_answers, evaluate_sequences
from recprep.session import staged


@pytest.fixture()
def small_bounds(spark):
    spark.conf.set("recprep.broadcast.maxRows", "10")
    yield
    spark.conf.unset("recprep.broadcast.maxRows")


def vectors(spark):
    rows = [(i, [i / 7, (i * 31 % 17) / 3, 1.0]) for i in range(1, 3000)] + [(5000, None), (None, [1.0, 2.0, 3.0])]
    return spark.createDataFrame(rows, "vec_id int, embedding array<float>")


def lists(spark, more=()):
    rows = [(u, [0, 1 + u % 60, 2 + u % 50, 2 + u % 50, 9000], [1 + (u * 7 + j * 97) % 3100 for j in range(30)] + [5000])
            for u in range(200)]
    return spark.createDataFrame([*rows, *more], "user_id int, eval_seqs array<int>, candidate_items array<int>")


ODD = [(200, [0, 0, 9000], [3, 4]), (201, [1, None, 3], []), (7, [0, 9, 9000], [5, None, 6]), (7, [2], [5, 5]),
       (None, [1, 2], [3, 4]), (None, [4], [3]), (202, None, [1, 2]), (203, [1], None), (204, [8000, 5000], [1])]


def rows(df):
    return sorted(((r.user_id is None, r.user_id or 0, r.position, r.item is None, r.item or 0, r.score is None,
                    round(r.score or 0.0, 9)) for r in df.collect()))


def test_lists_are_scored_where_the_vectors_are_read(spark, monkeypatch, small_bounds):
    """Same scores as by joins, with no exchange of vectors, whatever a task
    takes at once."""
    df, t, written = lists(spark, ODD), vectors(spark), []
    spark.conf.unset("recprep.broadcast.maxRows")
    want = rows(score_candidates(df, item_vectors=t, mask_id=9000))
    spark.conf.set("recprep.broadcast.maxRows", "10")
    monkeypatch.setattr(scoring, "staged", lambda df, name: (written.append(name), staged(df, name))[1])
    monkeypatch.setattr(list_scoring, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(list_scoring, "GROUP_BYTES", 4000)
    monkeypatch.setattr(list_scoring, "FILE_BYTES", 40_000)
    out = score_candidates(df, item_vectors=t, mask_id=9000)
    assert written == ["item-vectors", "candidate-lists"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "embedding" not in plan
    assert rows(out) == want


def test_vectors_that_lists_cannot_use(spark):
    def length(rows, kind="vec_id int, embedding array<float>"):
        return list_scoring.vector_length(spark.createDataFrame(rows, kind))
    assert length([(1, [1.0, 2.0]), (None, [1.0, 2.0]), (2, None)]) == 2
    assert length([(1, [1.0]), (1, [1.0])]) is None
    assert length([(1, [1.0]), (2, [1.0, 2.0])]) is None
    assert length([(1, [1.0, None])]) is None
    assert length([("1", [1.0])], "vec_id string, embedding array<float>") is None


def test_layout_names_every_row_group(spark, monkeypatch):
    monkeypatch.setattr(list_scoring, "GROUP_BYTES", 4000)
    monkeypatch.setattr(list_scoring, "FILE_BYTES", 40_000)
    layout = list_scoring.lay_out(vectors(spark), 3, 200_000)
    ends = [(least, most) for _, _, least, most in layout.groups]
    assert len({name for name, *_ in layout.groups}) > 2 and ends == sorted(ends)
    assert ends[0][0] == 1 and ends[-1][1] == 5000 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_metrics_of_lists_as_in_the_long_form(spark):
    nan = float("nan")
    each = [[1.0, 1.0, 2.0], [nan, 3.0, nan, 4.0], [None, 1.0, None], [3.0, nan, None, 3.0], [0.0, -0.0, 0.0], [2.0],
            [None], [1.0, float("inf"), None, float("-inf")]]
    df = spark.createDataFrame(list(enumerate(each)), "user_id int, scores array<double>")
    long = df.select("user_id", F.posexplode("scores").alias("position", "score")).withColumn(
        "label", (F.col("position") == 0).cast("int"))
    want = ranking_metrics(long, ks=(1, 2, 3)).first().asDict()
    got = ranking_metrics_arrays(_ranked_answers(df), "scores", "labels", ks=(1, 2, 3)).first().asDict()
    assert got == pytest.approx(want)


@pytest.mark.parametrize("more", [(), ODD])
def test_evaluation_above_the_bounds(spark, tmp_path, small_bounds, more):
    lists(spark, more).write.parquet(str(tmp_path / "eval"))
    got = evaluate_sequences(spark, str(tmp_path / "eval"), vectors(spark), mask_id=9000, ks=(2, 5))
    assert ("Window" in got._jdf.queryExecution().optimizedPlan().toString()) == bool(more)
    got = got.first().asDict()
    spark.conf.unset("recprep.broadcast.maxRows")
    want = evaluate_sequences(spark, str(tmp_path / "eval"), vectors(spark), mask_id=9000, ks=(2, 5)).first().asDict()
    assert got == pytest.approx(want)


def test_shuffle_files_end_with_the_write(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def shuffles():
        return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*")}

    before = shuffles()
    out = staged(spark.range(5000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffles() <= before
    assert out.count() == 7
