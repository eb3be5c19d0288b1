"""partsflow: supply-chain change-data-capture analytics on Spark.

Public entry points
-------------------
``operators.clean.clean``             row-validity filter + typed projection
``operators.cdc.scd1`` / ``scd2``      change events -> type-1 / type-2 dimension
``operators.cdc.as_of``                version of a key valid at a sequence
``operators.joins.left_join``          skew-safe left outer equi-join
``operators.ordered``                  bounded-group ordered look-ups
``operators.sampling``                 exact-size sampling
``sources.files``                      landing readers (batch, streaming)
``sinks.tables``                       clustered Parquet writers, catalog tables
``plans.batch.Flow`` / ``run_batch``   the whole flow as batch DataFrames
``streaming.pipeline.run_pipeline``    triggered incremental pipeline
"""
