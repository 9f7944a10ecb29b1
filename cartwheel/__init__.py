"""cartwheel — basket and edit-activity analytics as Spark DataFrame plans.

Layout:
  sources/    test tables, order/edit JSON documents, the Parquet lake
  operators/  reusable skew-aware building blocks (sequencing, chunking, top-k)
  functions/  Column -> Column helpers (buckets, day names, rates)
  plans/      cleaning, marts, the question pack, checks, the warehouse store
  streaming/  Structured Streaming refresh of the warehouse snapshot
"""

__version__ = "0.1.0"
