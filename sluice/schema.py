"""Schemas of change events and bookmarks."""

from pyspark.sql import types as T

#: sync_id is fixed-width text: its order is the order of the log. doc is the image after the change, null if there is none.
CHANGE_EVENT = T.StructType([T.StructField("sync_id", T.StringType(), False), T.StructField("db", T.StringType()), T.StructField("coll", T.StringType()), T.StructField("op", T.StringType(), False), T.StructField("doc_key", T.IntegerType()), T.StructField("doc", T.DoubleType()), T.StructField("cluster_ts", T.TimestampType()), T.StructField("n_bytes", T.IntegerType())])
BOOKMARK = T.StructType([T.StructField("coll", T.StringType(), False), T.StructField("sync_id", T.StringType(), False), T.StructField("pending", T.MapType(T.StringType(), T.StringType()))])
#: Kinds of changes: what they are in a batch.
UNKNOWN, UNORDERED, ORDERED, DROP = 0, 1, 2, 3
