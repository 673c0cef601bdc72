"""marquee — film-finance analytics written as Spark DataFrame jobs.

Public functions take DataFrames (or a session plus paths) and return
DataFrames; no table is collected to the driver.  Most are lazy.  Some run
jobs while they are called and say so: ``top_movies`` and ``dense_top_k`` (a
bound, a written input), ``join_small_side`` (a size), ``load_table`` and
``run_all`` (they write), and the readers (file headers).  Sub-packages:

* ``functions`` — column expressions (validators, text, dates, JSON, ratio)
* ``operators`` — DataFrame -> DataFrame operators (contract cleaning,
  dense top-k, explode with ordinality, constraint checks, aggregates)
* ``sources``   — CSV / XML / JDBC / Parquet readers and writers
* ``plans``     — the end-to-end jobs and the analyst reports
* ``llm``       — training-data operators, which nothing else here imports
"""

__version__ = "0.2.0"
