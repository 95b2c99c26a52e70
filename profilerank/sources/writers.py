"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schema import ID


def format_scores(df: DataFrame, *scores: str) -> DataFrame:
    """Scores as text with six decimals."""
    return df.withColumns({s: F.format_string("%.6f", F.col(s)) for s in scores})


def flat(df: DataFrame) -> DataFrame:
    """Arrays of strings as one text, joined with ``;``, for formats without arrays."""
    arrays = [n for n, t in df.dtypes if t == "array<string>"]
    return df.withColumns({n: F.array_join(n, ";") for n in arrays}) if arrays else df


def sink_ranked(
    df: DataFrame, path: str, scores: tuple[str, ...] = (), order: str = "rank", form: str = "csv", single: bool = False,
    max_single: int = 1_000_000,
) -> None:
    """A ranked table with a header, ordered by rank.

    The rows are range partitioned by rank, so the files in name order are the ranking. ``single`` asks for one file,
    which one task writes; a table of more than ``max_single`` rows is then refused.
    """
    out = flat(format_scores(df, *scores)) if form == "csv" else df
    if single:
        if df.limit(max_single + 1).count() > max_single:
            raise ValueError(f"more than {max_single} rows are too many for one file")
        out = out.coalesce(1).sortWithinPartitions(order)
    else:
        out = out.repartitionByRange(order).sortWithinPartitions(order)
    writer = out.write.mode("overwrite")
    writer.option("header", True).option("escape", '"').csv(path) if form == "csv" else writer.format(form).save(path)


def sink_append(df: DataFrame, path: str, partition: str | None = None, form: str = "json") -> None:
    """Adds finished rows to a table; a stopped run continues from what is there."""
    writer = df.write.mode("append").format(form)
    (writer.partitionBy(partition) if partition else writer).save(path)


def sink_preview(df: DataFrame, path: str, n: int, score: str = "score") -> None:
    """The best n rows next to the full output, as ``<path>.top<n>``."""
    top = df.orderBy(F.desc(score), F.asc(ID)).limit(n)
    top.coalesce(1).sortWithinPartitions(F.desc(score), F.asc(ID)).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}.top{n}")
