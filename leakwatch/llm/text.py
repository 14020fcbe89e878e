"""Words, splits and staged tables shared by the operators of this package."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from leakwatch.session import fresh_dir

# A word is a run of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"

# bytes.translate table: A-Z to a-z, all other bytes as they are.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def lower_words(text):
    """Lower-cased (A-Z only) words of a Python string, as UTF-8 bytes; None has none.

    bytes.split() cuts at exactly the six characters that WORD excludes.
    """
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def word_array(text):
    """Column of the words of a text column, in order; null and blank texts give an empty array."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def remainder(doc_id, modulus):
    """crc32 of the id written as text, modulo `modulus`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def held_out(doc_id, modulus, part):
    """Whether the row belongs to the held-out part; a null id never does."""
    return F.coalesce(remainder(doc_id, modulus) == part, F.lit(False))


def learnable(doc_id, modulus, part):
    """Whether a row may be learned from: its id is known and not held out."""
    return F.coalesce(remainder(doc_id, modulus) != part, F.lit(False))


def staged(df, purpose):
    """Write a table to the folder all executors share and read it back.

    Cuts lineage, so a lost executor costs a reread of files. Values drawn while
    writing (row numbers) are fixed from then on.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_rows(df, rows, total=None):
    """About `rows` rows, or all if there are fewer: each is kept with the same chance.

    The bound holds whatever the size of the table, copies of rows included, and the draw
    has a fixed seed. Used only to fit models and to estimate costs.
    """
    total = df.count() if total is None else total
    return df if total <= rows else df.sample(fraction=rows / total, seed=7)


class Texts:
    """The texts of an Arrow column, decoded one at a time: a batch is not held twice."""

    def __init__(self, column):
        self.column = column

    def __len__(self):
        return len(self.column)

    def __iter__(self):
        return (value.as_py() for value in self.column)


def map_texts(df, keep, ddl, setup):
    """Columns `keep` of a table as they are, and the columns `ddl` made from its texts.

    `setup()` runs once in a task and returns a function from the texts of a batch
    (None for null) to one list or array (Arrow's or numpy's) per new column. Rows go through in Arrow batches, so kept
    values of any type come back unchanged, nulls included.
    """
    made = StructType.fromDDL(ddl)
    kept = df.select(*[F.col(f"`{c}`") for c in keep]).schema
    kinds = [(f.name, f.type) for f in to_arrow_schema(made)]

    def run(batches):
        make = setup()
        for batch in batches:
            columns = make(Texts(batch.column(batch.num_columns - 1)))
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + arrays, [*keep, *[n for n, _ in kinds]]
            )

    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text_in"))
    return source.mapInArrow(run, StructType([*kept.fields, *made.fields]))
