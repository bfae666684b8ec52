import pytest
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.sql import functions as F, types as T

from scorestream.catalog.stop_list import ENGLISH
from scorestream.functions import encode, labels, numeric, stem, text


def one(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_split_items_never_fail(spark):
    df = spark.createDataFrame([("a,b,c",), ("x",), (None,)], "v string")
    assert one(df, encode.delimited_item(F.col("v"), 1)) == ["b", None, None]
    assert one(df, encode.delimited_item(F.col("v"), -1)) == ["c", "x", None]
    assert one(df, encode.delimited_item(F.col("v"), -3)) == ["a", None, None]


def test_parse_delimited_casts_or_nulls(spark):
    schema = T.StructType().add("x", T.DoubleType()).add("n", T.IntegerType()).add("s", T.StringType())
    df = spark.createDataFrame([("1.5,2,a",), ("bad,2",), ("",)], "v string")
    rows = df.select(encode.parse_delimited(F.col("v"), schema).alias("r")).select("r.*").collect()
    assert [tuple(r) for r in rows] == [(1.5, 2, "a"), (None, 2, None), (None, None, None)]


def test_invalid_utf8_is_replaced_or_refused(spark):
    df = spark.createDataFrame([(bytearray(b"ok"),), (bytearray(b"a\xffb"),)], "v binary")
    assert one(df, encode.decode_utf8(F.col("v"))) == ["ok", "a�b"]
    with pytest.raises(Exception):
        one(df, encode.decode_utf8(F.col("v"), strict=True))


def test_json_with_corrupt_record(spark):
    schema = T.StructType().add("a", T.IntegerType())
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": ',), ('{"a": "x"}',)], "v string")
    parsed = df.select(encode.parse_json(F.col("v"), schema, "bad").alias("p")).select("p.*")
    rows = [tuple(r) for r in parsed.collect()]
    assert rows[0] == (1, None)
    assert rows[1] == (None, '{"a": ')
    assert rows[2][1] == '{"a": "x"}'


def test_base64_round_trip(spark):
    df = spark.createDataFrame([("größe.txt",), ("",)], "v string")
    assert one(df, encode.base64_text(encode.text_base64(F.col("v")))) == ["größe.txt", ""]


def test_maps_and_branches(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    assert one(df, labels.lookup(F.col("v"), {"a": 1.0, "b": 2.0})) == [1.0, None, None]
    assert one(df, labels.branch_code(F.col("v"), {"a": 1}, 9)) == [1, 9, 9]


def test_correct_flag_is_zero_on_null_and_unlisted(spark):
    rows = [("a", "a"), ("a", "b"), (None, None), ("c", "c"), (None, "a")]
    df = spark.createDataFrame(rows, "p string, l string")
    assert one(df, labels.correct_flag(F.col("p"), F.col("l"))) == [1, 0, 0, 1, 0]
    assert one(df, labels.correct_flag(F.col("p"), F.col("l"), ["a"])) == [1, 0, 0, 0, 0]


def test_percent_text(spark):
    df = spark.range(3).select(F.when(F.col("id") == 0, 1).otherwise(0).alias("c"))
    assert one(df, labels.percent_text(F.col("c"))) == ["33.33"]
    assert one(df.where("false"), labels.percent_text(F.col("c"))) == [None]


def test_products_null_on_null_and_overflow(spark):
    rows = [(2, 3, 4), (None, 3, 4), (2_000_000_000, 2, 1)]
    df = spark.createDataFrame(rows, "cool int, useful int, funny int")
    out = numeric.with_interactions(df, numeric.vote_interactions("cool", "useful", "funny"))
    assert [tuple(r)[3:] for r in out.collect()] == [
        (6, 8, 12, 24),
        (None, None, 12, None),
        (None, 2_000_000_000, 2, None),
    ]
    assert [f.dataType for f in out.schema.fields] == [T.IntegerType()] * 7


TEXTS = [
    "Don't STOP the café-goer!! x_y 42",
    "",
    "   ",
    "...",
    "Ünïcode naïve\nlines\tand tabs",
    "the the THE it",
]


def test_word_tokens_equal_the_library_tokenizer(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    tokenizer = RegexTokenizer(inputCol="text", outputCol="w", pattern="\\W")
    remover = StopWordsRemover(inputCol="w", outputCol="kept")
    library = remover.transform(tokenizer.transform(df)).select("w", "kept").collect()
    tokens = text.word_tokens(F.col("text"))
    stop = StopWordsRemover.loadDefaultStopWords("english")
    mine = df.select(tokens, text.without_words(tokens, stop)).collect()
    assert [tuple(r) for r in mine] == [tuple(r) for r in library]


def test_stop_list_is_the_library_list(spark):
    assert ENGLISH == StopWordsRemover.loadDefaultStopWords("english")


def test_normalised_and_finished_tokens(spark):
    df = spark.createDataFrame([("It's  12 o'clock, naïve Ñandú! --",)], "text string")
    tokens = text.normalize_tokens(text.document_tokens(F.col("text")))
    assert one(df, tokens) == [["Its", "oclock", "naïve", "Ñandú"]]
    assert one(df, text.finish_tokens(tokens)) == ["Its oclock naïve Ñandú"]


@pytest.mark.parametrize(
    "content, lines", [("", 1), ("a", 1), ("a\n", 2), ("a\nb", 2), ("\n" * 100, 101)]
)
def test_line_count(spark, content, lines):
    df = spark.createDataFrame([(content,)], "v string")
    assert one(df, text.line_count(F.col("v"))) == [lines]


def test_path_label(spark):
    df = spark.createDataFrame([("/data/flowers/rose/1.jpg",), ("/other/1.jpg",)], "p string")
    assert one(df, text.path_label(F.col("p"), "flowers")) == ["rose", ""]


# Examples printed in the 1980 paper, after all steps.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "digitizer": "digit", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electrical": "electr", "hopeful": "hope", "goodness": "good",
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "gyroscopic": "gyroscop", "adjustable": "adjust", "irritant": "irrit", "replacement": "replac",
    "adoption": "adopt", "communism": "commun", "activate": "activ", "effective": "effect",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "generalizations": "gener", "oscillators": "oscil", "is": "is", "as": "as", "I": "i",
}


def test_stems_of_the_paper(spark):
    df = spark.createDataFrame([(w,) for w in STEMS], "w string").repartition(2)
    got = {r.w: r.s for r in df.select("w", stem.stem_word(F.col("w")).alias("s")).collect()}
    assert got == STEMS
