"""Training-data operators: sharding, dedup, decontamination, formatting, packing, scoring.

Nothing outside this package imports it; ``queries.py`` registers its queries.
Common rules of every operator here:

* inputs are read through ``common.narrow`` (only the named columns, renamed),
  so extra columns of the input never clash with internal names;
* an empty table gives an empty result with the same schema;
* a null text counts as the empty text unless the operator says otherwise;
* intermediates that several plans read are staged as parquet in the shared
  folder of ``spark.checkpoint.dir``; nothing is cached on an executor.
"""
