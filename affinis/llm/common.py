"""What the operators of this subpackage share: table access and expressions over spans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but the six ASCII blanks.
BLANK_WORD = r"[^\x20\x09-\x0D]+"
#: Everything that ends a word of letters, digits and non-ASCII characters, once A-Z are lower case.
NOT_LOWER_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns of a table as one struct, so that columns of our own beside it meet no other of their name."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def partitions(spark: SparkSession) -> int:
    """Tasks of a shuffle that adaptive execution does not size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; used by name in several places, it would be computed in each."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_totals(numbers: Column) -> Column:
    """Totals up to and with each element of an ``array<bigint>``.

    Folding an array into an array copies it for every element, so the array is
    folded in pieces of about the square root of its length.
    """
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(numbers)))).cast("int")
    pieces = F.when(
        F.size(numbers) > 0,
        F.transform(F.sequence(F.lit(0), F.size(numbers) - 1, width), lambda i: F.slice(numbers, i + 1, width)),
    ).otherwise(F.array().cast("array<array<bigint>>"))
    return let(pieces, _totals_of_pieces)


def _totals_of_pieces(pieces: Column) -> Column:
    nothing = F.array().cast("array<bigint>")

    def fold(piece: Column, start: Column, inclusive: bool) -> Column:
        first = F.struct(start.cast("bigint").alias("sum"), nothing.alias("out"))
        step = lambda a, x: F.struct(
            (a["sum"] + x).alias("sum"),
            F.concat(a["out"], F.array(a["sum"] + x if inclusive else a["sum"])).alias("out"),
        )
        return F.aggregate(piece, first, step, lambda a: a["out"])

    sums = F.transform(pieces, lambda p: F.aggregate(p, F.lit(0).cast("bigint"), lambda a, x: a + x))
    return F.flatten(F.zip_with(pieces, fold(sums, F.lit(0), False), lambda p, s: fold(p, s, True)))


def regex_spans(text: Column, pattern: Column, measure=F.char_length) -> Column:
    """``array<struct<start, end, text>>`` of the leftmost non-overlapping matches, by built-in functions only.

    Splitting at the matches gives what lies between them, so starts and ends
    are running totals of lengths. ``measure`` turns a string into its length.
    """
    both = F.struct(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between")
    )

    def lengths(p: Column) -> Column:
        return F.zip_with(
            F.slice(p["between"], 1, F.size(p["found"])),
            p["found"],
            lambda g, m: (measure(g) + measure(m)).cast("bigint"),
        )

    def spans(p: Column) -> Column:
        return F.zip_with(
            let(lengths(p), running_totals),
            p["found"],
            lambda end, m: F.struct((end - measure(m)).alias("start"), end.alias("end"), m.alias("text")),
        )

    return let(both, spans)
