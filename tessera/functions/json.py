"""Per-line JSON decoding with a declared schema and corrupt-line detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_json_lines(lines: DataFrame, schema: T.StructType | str, col: str = "value") -> DataFrame:
    """Fields of ``schema`` plus ``_corrupt`` (the line is not a JSON object).

    Declare loosely typed fields (e.g. a score sent as ``5`` or ``"5"``) as
    string and convert them with ``try_cast``: both spellings then count and
    a malformed value becomes NULL instead of failing the job.

    Each line is parsed once; only those that the parser puts aside are looked
    at again, to tell a line that is no object from one with an odd value.
    """
    given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_text = T.StructType([*given.fields, T.StructField("_text", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_text"}
    parsed = lines.select(F.col(col).alias("_line"), F.from_json(F.col(col), with_text, options).alias("_j"))
    aside = F.col("_j").isNull() | F.col("_j._text").isNotNull()
    corrupt = F.when(aside, F.from_json("_line", "map<string,string>").isNull()).otherwise(False)
    return parsed.select(*[F.col("_j")[f.name].alias(f.name) for f in given.fields], corrupt.alias("_corrupt"))


def corrupt_count(decoded: DataFrame) -> DataFrame:
    return decoded.agg(F.sum(F.col("_corrupt").cast("long")).alias("corrupt_lines"),
                       F.count(F.lit(1)).alias("lines"))
