"""Station dimension operators: projection, typing with rejects,
enrichment, regions, manifest, and last-wins deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import UNKNOWN_REGION
from ..schemas import TRANSFORMED_STATIONS
from .joins import DEFAULT_BROADCAST_ROWS, assign_state, lookup_state_code
from .regions import assign_region

RECORD_COLUMNS = ("id", "name", "latitude", "longitude", "elevation", "elevation_unit",
                  "state", "datacoverage", "mindate", "maxdate")


def valid_station_ids(df: DataFrame, station: str = "station") -> DataFrame:
    """Rows whose station id is present and non-empty."""
    return df.where(F.col(station).isNotNull() & (F.col(station) != ""))


def station_projection(catalog: DataFrame) -> DataFrame:
    """Catalog record -> station record fields (``elevationUnit`` renamed)."""
    return catalog.select("id", "name", "latitude", "longitude", "elevation",
                          F.col("elevationUnit").alias("elevation_unit"),
                          "datacoverage", "mindate", "maxdate")


def enrich_stations(ids: DataFrame, catalog: DataFrame, cells: DataFrame,
                    codes: DataFrame | None = None, resolution: float = 1.0,
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    exact: bool = False) -> DataFrame:
    """Station ids -> full station records with a state code.

    Ids without a catalog record are dropped (see ``unresolved_stations``).
    The state is the code of the region whose grid cell holds the station,
    or, with ``exact``, whose borders do (``cells`` is then a region index of
    this resolution); NULL when there is none or the region has no code.
    """
    found = ids.select("id").distinct().join(catalog, "id", "inner")
    rec = station_projection(found)
    rec = (assign_region if exact else assign_state)(rec, cells, resolution, out="_state_name")
    rec = lookup_state_code(rec, codes, name_col="_state_name", out="state")
    return rec.select(*RECORD_COLUMNS)


def unresolved_stations(ids: DataFrame, catalog: DataFrame) -> DataFrame:
    """Ids with no catalog record."""
    return ids.select("id").distinct().join(catalog.select("id"), "id", "left_anti")


def _try_double(c: str) -> Column:
    return F.col(c).cast("string").try_cast("double")


def _try_date(c: str) -> Column:
    return F.to_date(F.try_to_timestamp(F.col(c).cast("string")))


def typed_stations(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cast station records to the dimension schema.

    Returns ``(good, rejects)``. A row whose field is missing or does not
    convert goes to ``rejects`` with a reason, alone; the rest of the
    batch is kept. An empty ``id`` or ``state`` counts as missing (one is
    the key, the other a folder of the table).
    """
    typed = records.select(
        F.col("id").cast("string").alias("id"),
        F.col("name").cast("string").alias("name"),
        _try_double("latitude").alias("latitude"),
        _try_double("longitude").alias("longitude"),
        _try_double("elevation").alias("elevation"),
        F.col("elevation_unit").cast("string").alias("elevation_unit"),
        F.col("state").cast("string").alias("state"),
        _try_double("datacoverage").alias("datacoverage"),
        _try_date("mindate").alias("mindate"),
        _try_date("maxdate").alias("maxdate"),
        *[F.col(c).cast("string").alias(f"_raw_{c}") for c in RECORD_COLUMNS],
    )
    reason = None
    for c in RECORD_COLUMNS:
        missing = F.col(f"_raw_{c}").isNull()
        if c in ("id", "state"):
            missing = missing | (F.col(f"_raw_{c}") == "")
        bad = F.col(c).isNull() & ~missing
        cond_m = F.when(missing, F.lit(f"missing {c}"))
        cond_b = F.when(bad, F.lit(f"unparseable {c}"))
        reason = F.coalesce(cond_m, cond_b) if reason is None else F.coalesce(reason, cond_m, cond_b)
    typed = typed.withColumn("_reason", reason)
    good = typed.where(F.col("_reason").isNull()).select(
        *[F.col(f.name).cast(f.dataType) for f in TRANSFORMED_STATIONS.fields])
    rejects = typed.where(F.col("_reason").isNotNull()).select(
        *[F.col(f"_raw_{c}").alias(c) for c in RECORD_COLUMNS], F.col("_reason").alias("reason"))
    return good, rejects


def region_of(state: Column | str = "state") -> Column:
    """Snapshot folder of a station: its state, or ``unknown``."""
    s = F.col(state) if isinstance(state, str) else state
    return F.coalesce(F.when(s != "", s), F.lit(UNKNOWN_REGION))


def stations_by_region(stations: DataFrame) -> DataFrame:
    """Station count per region."""
    return (stations.groupBy(region_of("state").alias("region"))
            .agg(F.count(F.lit(1)).alias("stations")))


def manifest_summary(snapshot: DataFrame, last_updated, files: DataFrame | None = None) -> DataFrame:
    """One row: last_updated, total_stations, sorted regions, sorted files.

    ``files`` is a DataFrame with a ``file`` column (e.g. distinct
    ``_metadata.file_path`` of the snapshot). The arrays are the manifest:
    one entry per region and per file. A snapshot is written in runs of
    folders, so it has at most one file per region plus one per write task.
    """
    parts = stations_by_region(snapshot).withColumn("file", F.lit(None).cast("string"))
    if files is not None:
        parts = parts.unionByName(files.select(
            F.lit(None).cast("string").alias("region"), F.lit(None).cast("long").alias("stations"),
            F.col("file").cast("string").alias("file")))
    # One global aggregate over the per-region and per-file rows; NULLs are
    # skipped by collect_*, so each array only sees its own kind of row.
    summary = parts.agg(
        F.coalesce(F.sum("stations"), F.lit(0)).cast("int").alias("total_stations"),
        F.sort_array(F.collect_list("region")).alias("regions"),
        F.sort_array(F.collect_set("file")).alias("files"))
    return summary.select(F.lit(last_updated).cast("date").alias("last_updated"),
                          "total_stations", "regions", "files")


def dedupe_last_wins(df: DataFrame, key: str = "id", order: tuple[str, ...] = ("snapshot_date",)) -> DataFrame:
    """One row per ``key``: the one with the greatest ``order`` columns.

    Expressed as ``max(struct(order..., payload...))`` grouped by key. That
    is an ordinary aggregate, so it is computed partially on each map task
    before the shuffle: an id with very many copies never reaches one task
    as raw rows (a ``row_number`` window would sort them all in one task).
    Remaining ties are broken by the payload, so the result is
    deterministic.
    """
    payload = [c for c in df.columns if c != key and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload]))
    return (df.groupBy(key).agg(best.alias("_best"))
            .select(key, *[F.col(f"_best.{c}").alias(c) for c in list(order) + payload]))


def station_union(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing stations plus new ones; a new record replaces an old one."""
    cols = list(RECORD_COLUMNS)
    both = (existing.select(*cols).withColumn("_rank", F.lit(0))
            .unionByName(new.select(*cols).withColumn("_rank", F.lit(1))))
    return dedupe_last_wins(both, "id", ("_rank",)).select(*cols)

