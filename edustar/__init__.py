"""edustar: a star schema of public school data, its checks and its insights as Spark jobs.

Layers, each a plain function over DataFrames:

* ``sources``   - CSV landing, header rules, and the mapping of the driver tables to
                  the three all-text raw tables.
* ``functions`` - Column helpers (casts, codes, surrogate keys, period labels).
* ``operators`` - staging views, mart tables, data checks, insights, dashboard views,
                  and the query screen.
* ``plans``     - the build (raw -> staging -> marts), the query catalog and the
                  DuckDB oracle text.
"""

__version__ = "0.1.0"
