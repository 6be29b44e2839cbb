"""Hand-computed cases for the text, metadata and field functions."""

from pyspark.sql import functions as F

from pagewright.config import PageConfig
from pagewright.functions import fields as FD
from pagewright.functions import metadata as M
from pagewright.functions import text as T
from pagewright.operators.hierarchy import digits_or_zero
from pagewright.sources import pages as P


def one(spark, col_fn, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col_fn(F.col(schema.split()[0])).alias("r")).first()[0]


def test_hyphen_join(spark):
    assert one(spark, T.fix_hyphenation, "a word: amy-\nloid.") == "a word: amyloid."
    assert one(spark, T.fix_hyphenation, "a word: amy- loid.") == "a word: amyloid."
    assert one(spark, T.fix_hyphenation, "a-\nb-\nc") == "abc"
    assert one(spark, T.fix_hyphenation, "pre- and post") == "preand post"
    # Unicode word characters join too (Python semantics)
    assert one(spark, T.fix_hyphenation, "é-\nà") == "éà"


def test_header_footer(spark):
    assert one(spark, T.remove_header_footer, "Short text") == "Short text"
    page = ("Journal of Science 2023\nPage 42\n\nThis is the actual content of the article.\n"
            "It spans multiple lines.\n\nCopyright 2023\ndoi:10.1234/js.2023")
    # The four-word first line matches no pattern (only one word + digits does), so it stays.
    assert one(spark, T.remove_header_footer, page) == (
        "Journal of Science 2023\nThis is the actual content of the article.\nIt spans multiple lines.")


def test_page_assembly(spark):
    pages = spark.createDataFrame([(1, 0, "This is a test text with a hyphenated word: amy-\nloid.")],
                                  "doc_id long, page_num int, page_text string")
    out = P.assemble_articles(pages, PageConfig()).first()
    assert out.raw_text == "This is a test text with a hyphenated word: amyloid.\n\n"
    assert P.pages_by_page(spark.createDataFrame([(1, 0, "Page 1 text.")], "doc_id long, page_num int, page_text string")) \
        .first().page_text == "Page 1 text."


def test_clean_article(spark):
    raw = "This is a test text with a hyphenated word: amyloid.\n\n"
    assert one(spark, lambda c: T.clean_article(c, lowercase=True), raw) == \
        "this is a test text with a hyphenated word: amyloid."
    assert one(spark, T.remove_citations, "TDP-43 and APOE4 in 12 of 30 patients (3) in 2023.") == \
        "TDP-and APOEin of patients  in ."
    assert one(spark, lambda c: T.remove_citations(c, True), "TDP-43 in (3) and [4].") == "TDP-43 in  and ."


def test_keyword_filter(spark):
    assert one(spark, T.keyword_line_filter, "The Journal\n body \n\nreceived x\nok") == "body\nok"


def test_dates(spark):
    d = F.lit("1999-09-09")
    assert one(spark, lambda c: M.publication_date(c, d), "Published 2020/1/5") == "2020-1-5"
    assert one(spark, lambda c: M.publication_date(c, d), "Accepted: March 7, 2021") == "2021-03-07"
    assert one(spark, lambda c: M.publication_date(c, d), "Received Feb 2019") == "2019-01-01"
    assert one(spark, lambda c: M.publication_date(c, d), "nothing here") == "1999-09-09"
    assert one(spark, lambda c: M.publication_date(c, d), "Copyright 2017, 2019 Society") == "2019-01-01"


def test_title_and_doi(spark):
    text = "Abstract\n\nfoo\n"
    assert one(spark, M.title, text) == "Abstract"          # stop before any candidate -> first line
    text = "Short\n\nA real title for the paper.\n\nBody"
    assert one(spark, M.title, text) == "A real title for the paper"
    assert one(spark, M.doi, "see doi:10.1000/xyz123 now") == "10.1000/xyz123"
    assert one(spark, M.doi, "https://doi.org/10.5/abc") == "10.5/abc"


def test_digits_and_stamps(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(digits_or_zero(F.col("s"))).collect()] == [12, 0, 0]
    df = spark.createDataFrame([("0",), ("2020-01-02T03:04:05",), ("junk",)], "s string")
    r = df.select(F.date_format(FD.epoch_millis_to_timestamp(F.col("s")), "yyyy-MM-dd").alias("e"),
                  F.date_format(FD.iso_to_timestamp(F.col("s")), "yyyy-MM-dd HH:mm:ss").alias("i")).collect()
    assert r[0].e == "1970-01-01" and r[1].i == "2020-01-02 03:04:05" and r[2].e is None and r[2].i is None


def test_json_default_fill(spark):
    df = spark.createDataFrame([('{"id": "a", "name": null}',), ('{"id": "b"}',)], "js string")
    r = df.select(FD.json_field(F.col("js"), "name", F.lit("No Name found")).alias("n")).collect()
    assert r[0].n is None and r[1].n == "No Name found"
