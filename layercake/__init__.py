"""layercake: layered (bronze -> silver -> gold) retail analytics on Spark.

Sub-packages:

* ``functions``  -- Column -> Column cleaning functions (names, codes, dates, amounts).
* ``operators``  -- DataFrame -> DataFrame operators (keep-latest, validity intervals,
  gap-free keys, balanced enrichment joins, data-quality rules).
* ``sources``    -- dataset catalog, CSV ingest, layer paths and Parquet read/write.
* ``plans``      -- the silver and gold datasets, the pipeline runners and CLI.
* ``llm``        -- operators for training-data corpora (optional).
"""

from layercake.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
