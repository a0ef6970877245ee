"""The four batch jobs of the workflow: clean, analyse, recommend, warehouse.

Each reads its inputs from paths, runs the operators and writes DataFrames;
no result passes through the driver.  Bounded results (top-k tables, the
ten-row rating distribution, one-row summaries) are written as one file;
per-user and per-movie tables stay split across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelstat.operators import clean, recommend, stats
from reelstat.plans import warehouse_sql
from reelstat.session import join_path
from reelstat.sources import cached, files, materialize, qualified, register_external, schemas


def _out(base: str, name: str) -> str:
    return join_path(base, name)


def clean_job(spark: SparkSession, ratings_csv: str, movies_csv: str, out_dir: str,
              fmt: str = "csv", tz: str | None = None) -> dict[str, str]:
    """Raw CSVs -> ratings_clean, movies_clean, data_summary."""
    r = clean.clean_ratings(files.read_ratings(spark, ratings_csv), tz=tz)
    m = clean.clean_movies(files.read_movies(spark, movies_csv))
    paths = {"ratings_clean": _out(out_dir, "ratings_clean"),
             "movies_clean": _out(out_dir, "movies_clean"),
             "data_summary": _out(out_dir, "data_summary")}
    files.write_table(r, paths["ratings_clean"], fmt=fmt)
    files.write_table(m, paths["movies_clean"], fmt=fmt)
    r2 = files.read_ratings_clean(spark, paths["ratings_clean"], fmt=fmt)
    m2 = files.read_movies_clean(spark, paths["movies_clean"], fmt=fmt)
    files.write_result(stats.dataset_summary(r2, m2), paths["data_summary"], fmt=fmt, single_file=True)
    return paths


def analyses(ratings: DataFrame, movies: DataFrame, min_count: int = 50) -> dict[str, DataFrame]:
    """The six analyses and the totals, as DataFrames (nothing executed yet)."""
    return {
        "rating_distribution": stats.rating_distribution(ratings),
        "popular_movies": stats.popular(ratings, movies),
        "top_rated_movies": stats.top_rated(ratings, movies, min_count=min_count),
        "genre_distribution": stats.genre_distribution(movies),
        "user_activity": stats.user_activity(ratings),
        "user_activity_stats": stats.user_activity_stats(ratings),
        "year_ratings": stats.year_trend(ratings, movies),
        "overall_summary": stats.overall_summary(ratings, movies),
    }


def chart_series(ratings: DataFrame, movies: DataFrame, model=None, train: DataFrame | None = None,
                 test: DataFrame | None = None) -> dict[str, DataFrame]:
    """The series behind the five charts, in the order the charts draw them.

    fig1 ratings per value (0.5 .. 5.0), fig2 the ten most rated movies,
    fig3 genre shares within the top ten, fig4 the latest fifteen release
    years oldest first, fig5 the model metrics (when a model is given).
    Every series is a small bounded DataFrame; drawing is left to the caller.
    """
    out = {
        "fig1_rating_distribution": stats.rating_distribution(ratings).orderBy("rating"),
        "fig2_popular": stats.popular(ratings, movies),
        "fig3_genre_share": stats.genre_share(movies),
        "fig4_year_trend": stats.year_trend(ratings, movies).orderBy("year"),
    }
    if model is not None and train is not None and test is not None:
        out["fig5_als_metrics"] = recommend.als_metrics(model, train, test)
    return out


BOUNDED = {"rating_distribution", "popular_movies", "top_rated_movies", "genre_distribution",
           "user_activity_stats", "year_ratings", "overall_summary",
           "rating_distribution_pct", "genre_avg", "year_production", "active_users", "movie_stats_top"}


def analysis_job(spark: SparkSession, ratings: DataFrame, movies: DataFrame, out_dir: str,
                 fmt: str = "csv", min_count: int = 50) -> dict[str, str]:
    """Write every analysis to ``out_dir/<name>``; inputs are cached once for all of them."""
    paths = {}
    with cached(ratings, movies):
        for name, df in analyses(ratings, movies, min_count).items():
            paths[name] = _out(out_dir, name)
            files.write_result(df, paths[name], fmt=fmt, single_file=name in BOUNDED)
    return paths


def recommend_job(spark: SparkSession, ratings: DataFrame, movies: DataFrame, out_dir: str,
                  k: int = 5, fmt: str = "parquet", **als_args) -> dict[str, str]:
    """Split, fit, evaluate, recommend both ways, similar items, save the model."""
    train, test = recommend.split_ratings(ratings)
    model = recommend.fit_als(train, **als_args)
    outs = {
        "als_metrics": recommend.als_metrics(model, train, test),
        "user_recs": recommend.user_recs(model, movies, k),
        "item_users": recommend.item_users(model, k),
        "similar_items": recommend.similar_items(model, movies, k),
    }
    paths = {}
    for name, df in outs.items():
        paths[name] = _out(out_dir, name)
        files.write_result(df, paths[name], fmt=fmt, single_file=name == "als_metrics")
    paths["model"] = _out(out_dir, "als_model")
    recommend.save_model(model, paths["model"])
    return paths


def warehouse_job(spark: SparkSession, ratings_dir: str, movies_dir: str, out_dir: str | None = None,
                  fmt: str = "csv", refresh: bool = False, table_dir: str | None = None,
                  **params) -> dict[str, DataFrame]:
    """External tables over the cleaned files, the warehouse statements, and the
    materialised ``movie_stats`` with its read-back.  Returns the result
    DataFrames (and writes them when ``out_dir`` is given).

    ``table_dir`` places ``movie_stats`` at a fixed location: without
    ``refresh`` an existing table there is kept (CREATE TABLE IF NOT EXISTS,
    also across sessions), with ``refresh`` it is rewritten.  The external tables are
    registered anew for the given folders (dropping one keeps its files), and all
    statements name them with their database, so no temporary view stands in for them.
    """
    register_external(spark, "ratings_ext", ratings_dir, schemas.RATINGS_CLEAN, fmt=fmt, replace=True)
    register_external(spark, "movies_ext", movies_dir, schemas.MOVIES_CLEAN, fmt=fmt, replace=True)
    tables = {"ratings": qualified(spark, "ratings_ext"), "movies": qualified(spark, "movies_ext")}
    materialize(warehouse_sql.run(spark, "movie_stats", **tables), qualified(spark, "movie_stats"),
                mode="overwrite" if refresh else "ignore", path=table_dir)
    names = ["rating_distribution_pct", "genre_avg", "year_production", "high_score",
             "active_users", "movie_stats_top"]
    results = {}
    for n in names:
        args = {k: v for k, v in params.items() if k in warehouse_sql.DEFAULTS.get(n, {})}
        if n == "movie_stats_top":
            args["table"] = qualified(spark, "movie_stats")
        results[n] = warehouse_sql.run(spark, n, **tables, **args)
    if out_dir:
        for n, df in results.items():
            files.write_result(df, _out(out_dir, n), single_file=n in BOUNDED)
    return results
