"""Line de-duplication over windows of consecutive lines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.scratch import write_table

#: A window with more than this share of all windows is joined by broadcast; at most 1 / HOT_SHARE of them can exist.
HOT_SHARE = 0.001


def without_repeated_lines(documents: DataFrame, window: int = 3, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the lines of repeated windows removed; adds n_lines and n_removed.

    A window is ``window`` consecutive lines of a text (split at line feeds) that are not all blank. Of equal windows
    anywhere, the first by (doc_id, text's hash, line) stays; the lines of every later one go, and overlapping windows go
    as one span. Copies inside one text count too. Windows are told apart by 128 bits of hash.

    A null text stays null and has 0 lines; an empty one has one line. Shorter texts than a window, and rows without a
    doc_id, are returned as they are. Repeated rows are the same document: they keep the same lines. All columns stay;
    the added ones replace columns of the same names.
    """
    rows = documents.withColumns({"_id": F.col(id_column).cast("long"), "_hash": F.xxhash64(text), "_lines": F.split(text, "\n", -1)})
    parts = [f"element_at(_lines, p + {i + 1})" for i in range(window)]
    spans = f"transform(sequence(0, size(_lines) - {window}), p -> struct(p AS p, xxhash64({', '.join(parts)}) AS h, xxhash64({', '.join(reversed(parts))}, 1) AS g, trim(concat({', '.join(parts)})) = '' AS blank))"
    windows = (
        rows.where(F.col("_id").isNotNull() & (F.size("_lines") >= window))
        .select("_id", "_hash", F.inline(F.expr(spans)))
        .where("NOT blank")
        .select("h", "g", F.struct("_id", "_hash", "p").alias("at"))
    )
    windows = write_table(windows, "line-windows")
    repeated = windows.groupBy("h", "g").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = write_table(repeated, "repeated-windows")
    hot_count = int(windows.count() * HOT_SHARE)
    hot, cold = repeated.where(F.col("n") > hot_count), repeated.where(F.col("n") <= hot_count)
    met = windows.join(F.broadcast(hot), ["h", "g"]).unionByName(windows.join(cold, ["h", "g"]))
    later = met.where("at <> first").select("at.*").groupBy("_id", "_hash").agg(F.sort_array(F.collect_set("p")).alias("_gone"))

    @F.pandas_udf("text string, n_removed long")
    def cut(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        out = []
        for value, places in zip(texts, gone):
            if places is None or value is None:
                out.append((value, 0))
                continue
            covered = {i for p in places for i in range(p, p + window)}
            kept = [line for i, line in enumerate(value.split("\n")) if i not in covered]
            out.append(("\n".join(kept), len(covered)))
        return pd.DataFrame(out, columns=["text", "n_removed"])

    rows = rows.withColumn("n_lines", F.coalesce(F.greatest(F.size("_lines"), F.lit(0)), F.lit(0)).cast("long")).drop("_lines")
    found = rows.join(later, ["_id", "_hash"], "left").withColumn("_cut", cut(text, "_gone"))
    return found.withColumns({text: F.col("_cut.text"), "n_removed": F.col("_cut.n_removed")}).drop("_id", "_hash", "_gone", "_cut")
