"""reelstat — explicit-feedback ratings analytics and recommendation on Spark.

Every operator takes Spark DataFrames and returns a DataFrame; nothing is
collected to the driver except one-row scalars where an API needs a number.

Sub-packages
------------
sources    schemas, file sources/sinks, catalog tables, test-table adapter
functions  column expressions (dates, titles, genres, rounding, hashing)
operators  cleaning, statistics, warehouse aggregates, recommendation, similarity
plans      the registered queries, their SQL oracles, the SQL (warehouse) route, jobs
"""


def __getattr__(name):
    # lazy, so Python workers that unpickle a kernel do not import Spark modules
    if name in ("build_session", "ensure_checkpoint_dir"):
        from reelstat import session
        return getattr(session, name)
    raise AttributeError(name)
