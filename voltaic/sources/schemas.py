"""Files of one table whose column types differ: read by groups of equal types, brought to common ones.

Types that a feed infers anew for every load change with the data (a column of whole numbers today, of
fractions tomorrow).  Spark doesn't read such files together.  Here the files are put in groups that share their types
(footers are merged by Spark, halves at a time, so a change at one point in time costs a
few merges and not one a file), each group is cast to the least common types, and the groups are stacked.
A step that could lose something is refused: between text, numbers, times and flags when the files
are listed, for a whole number too large for a double when the row is read.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole number types from the narrowest on, and the decimal digits each needs.
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


class TypesDiffer(ValueError):
    """Column types that have no common type without loss."""


def common_type(a: T.DataType, b: T.DataType, name: str = "value") -> T.DataType:
    """The least type that holds the values of both."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.NullType):
            return y
        if isinstance(x, WHOLE) and isinstance(y, WHOLE):
            return x if WHOLE.index(type(x)) > WHOLE.index(type(y)) else y
        if isinstance(x, WHOLE) and isinstance(y, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        if isinstance(x, T.FloatType) and isinstance(y, T.DoubleType):
            return y
        if isinstance(x, WHOLE) and isinstance(y, T.DecimalType):
            return _decimal(DIGITS[type(x)], 0, y, name)
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return _decimal(a.precision - a.scale, a.scale, b, name)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType, f"{name}[]"), a.containsNull or b.containsNull)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema(a, b, f"{name}.")
    raise TypesDiffer(f"{name} is {a.simpleString()} in some files and {b.simpleString()} in others: no common type holds both")


def _decimal(whole: int, scale: int, other: T.DecimalType, name: str) -> T.DecimalType:
    whole, scale = max(whole, other.precision - other.scale), max(scale, other.scale)
    if whole + scale > 38:
        raise TypesDiffer(f"{name} needs a decimal of {whole + scale} digits")
    return T.DecimalType(whole + scale, scale)


def common_schema(a: T.StructType, b: T.StructType, at: str = "") -> T.StructType:
    """The columns of both (by name, those of ``a`` first) with their common types."""
    there = {f.name: f for f in b.fields}
    fields = [T.StructField(f.name, common_type(f.dataType, there[f.name].dataType, at + f.name) if f.name in there else f.dataType, True)
              for f in a.fields]
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name not in a.fieldNames()])


def widened(column: Column, have: T.DataType, want: T.DataType, name: str) -> Column:
    """The column as the common type; a whole number that a double doesn't hold exactly is an error."""
    if have == want:
        return column
    if isinstance(have, T.LongType) and isinstance(want, T.DoubleType):
        double = column.cast("double")
        # 2**63 as a double would come back as the largest long
        exact = column.isNull() | ((double < F.lit(2.0**63)) & (double.cast("long") == column))
        return F.when(exact, double).otherwise(F.raise_error(F.concat(
            F.lit(f"{name}: "), column.cast("string"), F.lit(" can't be held by a double"))).cast("double"))
    return column.cast(want)


def stacked(frames: list[DataFrame]) -> DataFrame:
    """The rows of all frames by name, columns cast to their common types; missing ones are NULL."""
    schema = frames[0].schema
    for f in frames[1:]:
        schema = common_schema(schema, f.schema)
    want = {f.name: f.dataType for f in schema.fields}
    out = None
    for f in frames:
        own = f.select(*[widened(F.col(f"`{c.name}`"), c.dataType, want[c.name], c.name).alias(c.name) for c in f.schema.fields])
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out.select(*[F.col(f"`{n}`") for n in schema.names])


def conform(df: DataFrame, like: T.StructType) -> T.StructType:
    """The schema that rows of ``df`` and a stored table of schema ``like`` have in common; raises TypesDiffer."""
    return common_schema(like, df.schema)


def read_groups(spark: SparkSession, paths: list[str], base: str | None = None, file_col: str | None = None) -> list[DataFrame]:
    """Parquet files or folders as few frames, each of files whose types agree, with the columns of all its files; ``file_col``
    adds the path of each row's file."""
    def load(some: list[str]) -> DataFrame:
        reader = spark.read.option("mergeSchema", "true")
        df = (reader.option("basePath", base) if base else reader).parquet(*some)
        return df.withColumn(file_col, F.col("_metadata.file_path")) if file_col else df

    try:
        return [load(paths)]
    except (PySparkException, Py4JJavaError) as e:
        if not _differ(e):
            raise
    return [load(g) for g in _groups(load, _files(spark, paths))]


def read_merged(spark: SparkSession, paths: list[str], base: str | None = None) -> DataFrame:
    """Parquet files or folders with the columns of all of them, types that differ brought to common ones."""
    groups = read_groups(spark, paths, base)
    return groups[0] if len(groups) == 1 else stacked(groups)


def _differ(e: Exception) -> bool:
    return "CANNOT_MERGE" in str(e)


def _files(spark: SparkSession, paths: list[str]) -> list[str]:
    """The data files below the paths, in order of their paths (partitions, then names)."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(paths)
    return sorted(r["path"] for r in rows.select("path").collect())


def _groups(load, files: list[str]) -> list[list[str]]:
    """The files in groups that Spark merges; neighbours first, then groups of equal types."""
    def cut(some: list[str]) -> list[tuple[list[str], T.StructType]]:
        try:
            return [(some, load(some).schema)]
        except (PySparkException, Py4JJavaError) as e:
            if len(some) == 1 or not _differ(e):
                raise
        half = len(some) // 2
        return cut(some[:half]) + cut(some[half:])

    out: list[tuple[list[str], T.StructType]] = []
    for own, schema in cut(files):
        types = {f.name: f.dataType for f in schema.fields}
        for k, (other, there) in enumerate(out):
            if all(types.get(f.name, f.dataType) == f.dataType for f in there.fields):
                both = T.StructType(there.fields + [f for f in schema.fields if f.name not in there.fieldNames()])
                out[k] = (other + own, both)
                break
        else:
            out.append((own, schema))
    return [own for own, _ in out]
