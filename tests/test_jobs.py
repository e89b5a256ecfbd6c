import pytest
from pyspark.sql import functions as F

from skytally import jobs
from skytally.functions.numeric import cosine_similarity, ring_position
from skytally.functions.sql import register_functions
from tests.conftest import rows

FLIGHT_LINES = """BDL,PHL,1,AA,0,0,5,2006-07-03,1,700,800,700,F1
BDL,PHL,2,BB,1,1,15,2006-07-03,1,800,900,800,F2

PHL,ATL,1,AA,0,0,NA,2006-07-05,3,1300,1500,1300,G1
PHL,ATL,1,AA,0,0,1,2006-07-05,3,1200,1400,1200,G2
ATL,BDL
"""


@pytest.fixture
def go(spark, tmp_path):
    for name, content in {
        "flights/f.csv": FLIGHT_LINES, "manifest": f"{tmp_path}/flights/f.csv\n", "origins": "BDL\n", "pairs": "BDL  PHL\n",
        "requests": "BDL PHL ATL 2006-07-03\nbad line\n", "titles": "The cow-bell\nA cow\n", "stops": "the\na\n",
        "links": "1: 2 3\n3: 2\n4: 1\n", "league": "1\n2\n3\n", "messages/m.txt": "t S 5 \nt S 500 \n",
        "ratings": "1::10::4::1\n1::20::2::1\n1::10::5::9\n", "movies": "10::Star, One::a\n20::Two::b\n",
        "points": "\n".join(f'"p{i}",{i},{i % 3}' for i in range(20)), "training": "\n".join(f"{i},1,{int(i > 9)}" for i in range(20)),
        "columns": "key\nv\n", "rows": "a 1:\nb 2\na 3\n",
    }.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(content)
    count = iter(range(1000))

    def run(job, *args):
        output = f"{tmp_path}/out{next(count)}"
        paths = [f"{tmp_path}/{a}" if (tmp_path / a).exists() else a for a in args]
        split = next((i for i, a in enumerate(paths) if a.startswith("-")), len(paths))
        jobs.run(spark, [job, *paths[:split], output, *paths[split:]])
        return spark.read.parquet(output)
    return run


def test_flight_jobs(go):
    assert rows(go("top-airports", "manifest", "-n", "2")) == [("BDL", 3), ("PHL", 4)]
    assert rows(go("rank-airports", "manifest").select("airport", "id")) == [("ATL", 2), ("BDL", 1), ("PHL", 0)]
    assert rows(go("rank-weekdays", "manifest").select("day_of_week", "perf")) == [(1, 0.5), (3, 1.0)]
    assert rows(go("airlines-from", "manifest", "origins")) == [("BDL", "1", 1.0, 1), ("BDL", "2", 0.0, 2)]
    assert go("airlines-between", "manifest", "pairs").count() == 2
    assert rows(go("mean-delay", "manifest", "pairs")) == [("BDL", "PHL", 10.0)]
    assert rows(go("best-trips", "manifest", "requests").select("flight_id1", "flight_id2")) == [("F1", "G2")]
    assert go("zipf", "manifest").count() == 3
    assert go("publish", "manifest").count() == 5


def test_stream_jobs(go):
    assert rows(go("stream-top-airports", "flights", "-n", "1")) == [("PHL", 4)]
    assert rows(go("stream-rank-weekdays", "flights").select("day_of_week", "perf")) == [(1, 0.5), (3, 1.0)]
    assert go("stream-airlines-from", "flights", "origins").count() == 2
    assert go("stream-airlines-between", "flights", "pairs").count() == 2
    assert rows(go("stream-mean-delay", "flights", "pairs")) == [("BDL", "PHL", 10.0)]
    assert rows(go("stream-best-trips", "flights", "requests").select("flight_id1", "flight_id2")) == [("F1", "G2")]
    assert rows(go("stream-alarms", "messages")) == [("t", "S", 500)]
    assert go("stream-alarms", "messages", "--min-value", "6").count() == 2
    assert ("S", 2) in rows(go("stream-word-count", "messages"))
    assert rows(go("stream-normalized-word-count", "messages")) == [("t", 2)]
    assert rows(go("stream-top-words", "messages", "-n", "1")) == [("t", 2)]


def test_text_link_and_table_jobs(go):
    assert rows(go("title-count", "titles", "stops")) == [("bell", 1), ("cow", 2)]
    assert rows(go("top-titles", "titles", "stops", "-n", "1")) == [("cow", 2)]
    assert dict(rows(go("title-statistics", "titles", "stops")))["Sum"] == 3
    assert rows(go("orphan-pages", "links")) == [(4,)]
    assert rows(go("popular-links", "links", "-n", "1")) == [(2, 2)]
    assert rows(go("popularity-league", "links", "league")) == [(1, 0), (2, 2), (3, 0)]
    assert rows(go("components", "links")) == [(i, 1) for i in (1, 2, 3, 4)]
    assert rows(go("shortest-paths", "links", "1")) == [(1, 0), (2, 1), (3, 1), (4, 2147483647)]
    assert rows(go("load-table", "columns", "rows")) == [("a", "3"), ("b", "2")]


def test_learning_jobs(go):
    assert rows(go("similar-movies", "ratings", "movies", "Star").select("movie_id", "score")) == [(10, 1.0), (20, 1.0)]
    assert go("kmeans", "points", "2").count() == 20
    assert {r.prediction for r in go("random-forest", "training", "training", "2").collect()} == {0.0, 1.0}


def test_sql_functions(spark):
    register_functions(spark)
    assert spark.sql("SELECT tokenize_sentence('a-b c''s 4d \\\\ e') AS w").first().w == ["a-b", "c", "s", "d", "e"]
    expected = spark.range(1).select(ring_position(F.lit("k")).alias("p"))
    assert rows(spark.sql("SELECT ring_position('k') AS p")) == rows(expected)
    vectors = spark.createDataFrame(
        [([(0, 3), (1, 4)], [(1, 2)])], "a ARRAY<STRUCT<user_index: BIGINT, rating: INT>>, b ARRAY<STRUCT<user_index: BIGINT, rating: INT>>")
    assert rows(vectors.selectExpr("calculate_similarity(a, b)")) == [(0.8,)]
    assert rows(vectors.select(cosine_similarity(vectors.a, vectors.b))) == [(0.8,)]
