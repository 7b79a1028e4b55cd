"""Operators for preparing training corpora: filtering, cleaning, de-duplication, tokenising and packing of documents.

Every operator takes DataFrames and returns DataFrames. The work inside tasks runs on Arrow batches with numpy; Spark
partitions, shuffles and joins. Intermediate tables go to the shared folder of ``spark.checkpoint.dir``.
"""
