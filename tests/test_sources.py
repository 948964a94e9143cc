from pyspark.sql import functions as F

from reelrank import schemas
from reelrank.sources import fixtures, tables, text
from tests.conftest import SF_SMALL


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_parse_movie_line_trims_and_keeps_blank_last_field(spark):
    row = ("260^ Star Wars ^Princess Leia is captured^121 minutes^September 21, 2004^1977^English"
           "^Action|Adventure|Sci-Fi^Mark Hamill|Harrison Ford^")
    out = text.parse_movies(lines(spark, row)).collect()[0]
    assert out.mid == 260 and out.name == "Star Wars" and out.genres == "Action|Adventure|Sci-Fi"
    assert out.directors == ""


def test_parse_rating_example(spark):
    out = text.parse_ratings(lines(spark, "1,31,2.5,1260759144")).collect()[0]
    assert (out.uid, out.mid, out.score, out.timestamp) == (1, 31, 2.5, 1260759144)


def test_parse_tag_with_comma_inside(spark):
    out = text.parse_tags(lines(spark, "15,1955, dentist, scary ,1193435061")).collect()[0]
    assert (out.uid, out.mid, out.tag, out.timestamp) == (15, 1955, "dentist, scary", 1193435061)


def test_lenient_parse_yields_null(spark):
    out = text.parse_ratings(lines(spark, "x,31,2.5,1"), strict=False).collect()[0]
    assert out.uid is None and out.mid == 31


def test_text_roundtrip_through_files(spark, tmp_dir):
    movies = fixtures.load_inputs(spark, SF_SMALL).movies
    text.movie_lines(movies).write.text(f"{tmp_dir}/movies")
    back = text.read_text_table(spark, f"{tmp_dir}/movies", "movie")
    assert back.exceptAll(movies).count() == 0 and movies.exceptAll(back).count() == 0


def test_projection_counts_and_types(spark):
    inp = fixtures.load_inputs(spark, SF_SMALL)
    assert inp.movies.count() == 200
    assert inp.ratings.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert [f.dataType.simpleString() for f in inp.ratings.schema.fields] == ["int", "int", "double", "int"]


def test_store_and_read_base_tables(spark, tmp_dir):
    inp = fixtures.load_inputs(spark, SF_SMALL)
    paths = tables.store_base_tables(inp.movies, inp.ratings, inp.tags, tmp_dir)
    r = tables.read_ratings(spark, paths["rating"])
    assert r.columns == schemas.RATING_COLUMNS
    assert r.count() == inp.ratings.count()


def test_typed_read_drops_extra_columns(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2, 3.0, 4, "extra")], "uid int, mid int, score double, timestamp int, x string")
    df.write.parquet(f"{tmp_dir}/r")
    assert tables.read_ratings(spark, f"{tmp_dir}/r").columns == schemas.RATING_COLUMNS


def test_search_documents_one_per_movie(spark, tmp_dir):
    from reelrank.operators import stats
    inp = fixtures.load_inputs(spark, SF_SMALL)
    docs = stats.movies_with_tags(inp.movies, inp.tags)
    tables.write_search_documents(docs, f"{tmp_dir}/docs")
    back = spark.read.json(f"{tmp_dir}/docs")
    assert back.count() == 200 and back.select("doc_id").distinct().count() == 200
    assert back.filter(F.col("doc_id") != F.col("mid").cast("string")).count() == 0


def test_lenient_parse_splits_out_bad_rows(spark):
    parsed = text.parse_ratings(lines(spark, "1,31,2.5,1260759144", "x,31,2.5,1", "2,3,4.0"),
                                strict=False, keep_line=True)
    good, bad = text.split_invalid(parsed, "rating")
    assert [r.uid for r in good.collect()] == [1]
    assert sorted(r.line for r in bad.collect()) == ["2,3,4.0", "x,31,2.5,1"]


def test_a_tag_may_hold_line_separators_of_unicode(spark):
    lines = spark.createDataFrame([("1,2,fun\u2028and\u0085more, really,9",), ("3,4,,7",)], "value string")
    rows = [tuple(r) for r in text.parse_tags(lines).orderBy("uid").collect()]
    assert rows == [(1, 2, "fun\u2028and\u0085more, really", 9), (3, 4, "", 7)]
