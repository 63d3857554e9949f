"""Row-wise Python functions over Arrow batches of bounded size."""

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Rows handed to Python at once are cut into pieces of about this many characters.
PIECE_CHARS = 4 << 20


def pieces(*columns: pd.Series, chars=PIECE_CHARS):
    """(from, to) cuts of a batch, so that what a function gathers stays bounded whatever the batch holds."""
    begin, held = 0, 0
    for i, text in enumerate(columns[0]):
        held += len(text) if text is not None else 0
        if held >= chars:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(columns[0]):
        yield begin, len(columns[0])


def with_result(docs: DataFrame, function, schema: str, name="result") -> DataFrame:
    """docs with a struct column of function(list of texts) -> list of tuples; one row in, one row out.

    A column of that name is replaced.
    """

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for begin, end in pieces(texts):
            rows += function(["" if t is None else t for t in texts.iloc[begin:end]])
        return pd.DataFrame(rows, columns=fields)

    fields = [f.split()[0] for f in schema.split(", ")]
    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return docs.withColumn(name, F.pandas_udf(run, schema)(F.col("text")))
