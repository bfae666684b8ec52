"""Feature stages for library pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizer,
    HashingTF,
    IndexToString,
    RegexTokenizer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from scorestream.functions.stem import stem_tokens
from scorestream.functions.text import document_tokens, normalize_tokens


class StemmedTokens(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Text to normalised, stemmed tokens; a stage that can be saved and streamed."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(
            self.getOutputCol(), stemmed_tokens(F.col(self.getInputCol()))
        )


def stemmed_tokens(text: Column) -> Column:
    return stem_tokens(normalize_tokens(document_tokens(text)))


def assemble(columns: Sequence[str], output: str = "features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid)


def checked_labels(df: DataFrame, column: str, most: int = 1000) -> DataFrame:
    """``df``, if its labels are few enough for the driver and for one literal map.

    The indexer brings all labels to the driver; a column with more than
    ``most`` values, such as a key taken for a label, is an error before that.
    """
    found = df.select(column).distinct().limit(most + 1).count()
    if found > most:
        raise ValueError(f"{column!r} has more than {most} values; it is no label")
    return df


def index_label(column: str, output: str = "label", invalid: str = "keep") -> StringIndexer:
    """Codes by falling frequency; unknown labels become one extra class."""
    return StringIndexer(inputCol=column, outputCol=output, handleInvalid=invalid)


def unindex_label(labels: Sequence[str], column: str = "prediction", output: str = "predicted_label") -> IndexToString:
    return IndexToString(inputCol=column, outputCol=output, labels=list(labels))


def scale(column: str = "features", output: str = "scaled", std: bool = True, mean: bool = False) -> StandardScaler:
    return StandardScaler(inputCol=column, outputCol=output, withStd=std, withMean=mean)


def recode_categories(
    column: str = "features", output: str = "recoded", most: int = 20, invalid: str = "error"
) -> VectorIndexer:
    """Positions with at most ``most`` values become codes, the others stay as they are.

    Zero has code 0, the other values follow in rising order.  Each task holds at
    most ``most`` + 1 values per position.  ``invalid`` says what becomes of rows
    with a value that was not seen: ``error``, ``skip``, or ``keep`` as one more code.
    """
    return VectorIndexer(inputCol=column, outputCol=output, maxCategories=most, handleInvalid=invalid)


def principal_components(k: int, column: str, output: str = "components") -> PCA:
    return PCA(k=k, inputCol=column, outputCol=output)


def token_stages(text: str, tokenizer: str = "words", output: str = "filtered") -> list:
    """Text to filtered tokens, by plain words or by stems."""
    if tokenizer == "words":
        first = RegexTokenizer(inputCol=text, outputCol="tokens", pattern="\\W")
    elif tokenizer == "stems":
        first = StemmedTokens(inputCol=text, outputCol="tokens")
    else:
        raise ValueError(f"tokenizer is 'words' or 'stems', not {tokenizer!r}")
    return [first, StopWordsRemover(inputCol="tokens", outputCol=output)]


def term_stages(
    column: str = "filtered",
    output: str = "term_vector",
    vocab_size: int | None = 10000,
    min_df: float | None = 5,
    idf: bool = False,
    buckets: int | None = None,
) -> list:
    """Tokens to term counts, optionally weighted by document rarity.

    None leaves the library's own limits in place.  With ``buckets`` terms are
    counted by the bucket of their hash; that stage learns nothing, so it also
    serves rows that are not there yet.
    """
    limits = {}
    if vocab_size is not None:
        limits["vocabSize"] = vocab_size
    if min_df is not None:
        limits["minDF"] = min_df
    counts = "term_counts" if idf else output
    if buckets is not None:
        stages: list = [HashingTF(inputCol=column, outputCol=counts, numFeatures=buckets)]
    else:
        stages = [CountVectorizer(inputCol=column, outputCol=counts, **limits)]
    if idf:
        stages.append(IDF(inputCol=counts, outputCol=output))
    return stages


def text_shape(df: DataFrame, text: str = "text") -> DataFrame:
    """Four measurements of a text: words, letters per word, ASCII and punctuation share."""
    content = F.col(text)
    n = F.length(content)
    squeezed = F.trim(F.regexp_replace(content, r"\s+", " "))
    blanks = F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "), F.lit("")))
    words = F.when(F.length(squeezed) > 0, blanks + 1).otherwise(F.lit(0))
    solid = F.length(squeezed) - blanks
    ascii_only = F.length(F.regexp_replace(content, r"[^\x00-\x7F]", ""))
    marks = n - F.length(F.regexp_replace(content, r"[.,;:!?]", ""))
    measured = df.withColumns({"_n": n, "_words": words, "_solid": solid})
    size = F.col("_n")
    return measured.select(
        *df.columns,
        F.col("_words").cast("double").alias("n_words"),
        F.coalesce(F.try_divide(F.col("_solid"), F.col("_words")), F.lit(0.0)).alias("avg_word"),
        F.coalesce(F.try_divide(ascii_only, size), F.lit(1.0)).alias("ascii_share"),
        F.coalesce(F.try_divide(marks, size), F.lit(0.0)).alias("mark_share"),
    )


#: Names of the columns ``text_shape`` adds.
SHAPE_COLUMNS = ["n_words", "avg_word", "ascii_share", "mark_share"]


def text_votes(df: DataFrame, text: str = "text") -> DataFrame:
    """Three counts taken from a text: lines, question and exclamation marks, digits."""
    content = F.col(text)

    def occurrences(pattern: str) -> Column:
        return F.length(content) - F.length(F.regexp_replace(content, pattern, ""))

    return df.withColumns(
        {
            "useful": occurrences(r"\n"),
            "funny": occurrences(r"[?!]"),
            "cool": occurrences(r"[0-9]"),
        }
    )


#: Names of the columns ``text_votes`` adds.
VOTE_COLUMNS = ["funny", "useful", "cool"]
