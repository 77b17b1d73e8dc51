"""Loading files whose rows do not all fit: good rows typed, the others in a reject table with their reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcart.session import materialise
from loomcart.sources.schemas import PRIMARY_KEYS, SCHEMAS

_LINE, _FILE = "_line", "_file"


@dataclass(frozen=True)
class Load:
    """``good`` has the table's columns; ``rejects`` has ``file, line, reasons``, the line as it stands in the file."""

    good: DataFrame
    rejects: DataFrame

    def counts(self) -> DataFrame:
        """``loaded_rows, rejected_rows`` in one row."""
        rejected = self.rejects.agg(F.count(F.lit(1)).alias("rejected_rows")).select("rejected_rows")
        return self.good.agg(F.count(F.lit(1)).alias("loaded_rows")).select("loaded_rows", rejected.scalar().alias("rejected_rows"))

    def by_reason(self) -> DataFrame:
        """``reason, rows``; a line with several reasons counts for each."""
        return self.rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def _fits(text: Column, kind: T.DataType) -> Column:
    """Whether a text is a value of the type as it stands: decimals may not lose digits."""
    value = text.try_cast(kind)
    if isinstance(kind, T.DecimalType):
        wide = text.try_cast(T.DecimalType(38, 18))
        return value.isNotNull() & (value.cast(T.DecimalType(38, 18)) == wide)
    return value.isNotNull()


def read_csv_checked(spark: SparkSession, path: str, table: str) -> Load:
    """A CSV file or folder with a header, read once as text and written out typed.

    A row is rejected if it has another number of fields than the header declares ("fields"), a value that its column's
    type does not take ("column: type"), or no value in the primary key ("column: missing"). An empty field is null. A
    header with other names is an error, as is a row that ends inside quotes over several lines, which counts as rows with
    wrong fields.
    """
    fields = SCHEMAS[table].fields
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in fields] + [T.StructField(_LINE, T.StringType())])
    text = (
        spark.read.schema(raw)
        .option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _LINE)
        .csv(path)
        .withColumn(_FILE, F.col("_metadata.file_path"))
    )
    torn = F.col(_LINE).isNotNull()
    key = PRIMARY_KEYS[table]
    reasons = [F.when(torn, "fields")]
    for f in fields:
        if not isinstance(f.dataType, T.StringType):
            reasons.append(F.when(~torn & F.col(f.name).isNotNull() & ~_fits(F.col(f.name), f.dataType), f"{f.name}: {f.dataType.simpleString()}"))
    reasons.append(F.when(~torn & F.col(key).isNull(), f"{key}: missing"))
    as_line = F.coalesce(_LINE, F.to_csv(F.struct(*[f.name for f in fields])))
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    checked = text.select(*typed, F.array_compact(F.array(*reasons)).alias("_reasons"), as_line.alias("_text"), _FILE)
    # Written, as pruned columns would change which rows count as torn.
    kept = materialise(checked.withColumn("_text", F.when(F.size("_reasons") > 0, F.col("_text"))), f"checked-{table}")
    good = kept.where(F.size("_reasons") == 0).select(*[f.name for f in fields])
    bad = kept.where(F.size("_reasons") > 0).select(F.col(_FILE).alias("file"), F.col("_text").alias("line"), F.col("_reasons").alias("reasons"))
    return Load(good, bad)
