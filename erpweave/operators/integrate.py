"""Union of systems and the chains of left joins that build the wide data sets.

All joins are left outer equi-joins by column name (``USING``: one copy of each key, taken
from the left side). Strategy is left to Catalyst and AQE: a side whose measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, any other pair is
shuffle-joined, and AQE splits skewed shuffle partitions at run time.

Two kinds of hot groups are handled explicitly:

* Null keys. A key that comes from the right side of an earlier left join is null for
  every unmatched row (MANDT is null for a third of the plant rows once their material is
  filtered out). Such rows can never match, but a hash shuffle sends all of them to one
  reducer. ``spread_null_keys`` gives them an extra join key (a hash of the row) that the
  right side never carries: the result is unchanged and the rows spread over all reducers.
* Hot right-side keys (one order with a third of all items). AQE can split a skewed
  partition of the preserved (left) side of a left join but not of the other side.
  ``split_right_skew`` therefore counts the right side's keys first (partial aggregation,
  so a hot key costs one row per map task) and keeps the keys with more than
  ``hot_key_rows`` rows, the ``MAX_HOT_KEYS`` hottest of them, which bounds the set that is
  broadcast whatever the size of the data; keys beyond it are joined unsalted. Both sides
  are tagged by broadcast joins (no shuffle). A hot key's right rows are hashed into
  ceil(count / hot_key_rows) salt buckets and its left rows are replicated once per bucket;
  cold keys keep salt 0. One left join on (keys, salt) then gives no task more than about
  ``hot_key_rows`` right rows of one key. A hot key always has partners, so the replicated
  copies that met an empty bucket are dropped by a marker column; cold rows keep left-join
  semantics. The count reads the right side's key and filter columns once more, so it is
  used for one-to-many tables (items, change items) and not for tables keyed by the join
  column (materials, order masters).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from erpweave.contracts import LOCAL_MATERIAL_CONTRACT, names
from erpweave.functions import any_null
from erpweave.operators.derive import FOREIGN
from erpweave.operators.guards import require_named_dataframes, require_optional_dataframe
from erpweave.sources.conform import conform

_SPREAD = "__erpweave_spread"
_ORIGIN = "__erpweave_right_origin"
_AREAS = "__erpweave_areas"


def union_systems(frames: Sequence[DataFrame], schema: StructType | None = None) -> DataFrame:
    """Bag union by column name of the same table from any number of systems.

    With ``schema`` every frame is first conformed to it, so independently typed extracts
    (an id read as int in one system and as text in another) union cleanly.
    """
    if not frames:
        msg = "union_systems needs at least one DataFrame"
        raise ValueError(msg)
    if schema is not None:
        frames = [conform(frame, schema) for frame in frames]
    return reduce(lambda left, right: left.unionByName(right), frames)


def _row_hash(frame: DataFrame) -> Column:
    """64-bit hash of all columns of a row (sent to the JVM as one SQL expression)."""
    return F.expr("xxhash64(" + ", ".join("`" + c.replace("`", "``") + "`" for c in frame.columns) + ")")


def _spread_column(frame: DataFrame, keys: list[str], left_side: bool) -> Column:
    if left_side:
        # Null-key rows get a hash of the whole row; all others 0.
        return F.when(any_null(keys), _row_hash(frame)).otherwise(F.lit(0).cast("long"))
    # The right side only carries 0 (its null-key rows -1), so a spread row finds no partner.
    return F.when(any_null(keys), F.lit(-1).cast("long")).otherwise(F.lit(0).cast("long"))


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str, spread: bool) -> DataFrame:
    if not spread:
        return left.join(right, on=keys, how=how)
    joined = left.withColumn(_SPREAD, _spread_column(left, keys, True)).join(
        right.withColumn(_SPREAD, _spread_column(right, keys, False)), on=[*keys, _SPREAD], how=how
    )
    return joined.drop(_SPREAD)


def _join_within(left: DataFrame, right: DataFrame, keys: list[str], within: list[str], nulls_match: Sequence[str]) -> DataFrame:
    """Left join by ``keys`` with ``within`` as a condition. An equality would become a key and be
    shuffled by, so it is written as a range; a null matches nothing in either form, unless it is
    one of ``nulls_match``."""
    other = {c: f"__erpweave_right_{i}" for i, c in enumerate([*keys, *within])}
    right = right.withColumnsRenamed(other)
    same = [F.col(c) == F.col(other[c]) for c in keys]
    for c in within:
        equal = F.col(other[c]).between(F.col(c), F.col(c))
        same.append(equal | (F.col(c).isNull() & F.col(other[c]).isNull()) if c in nulls_match else equal)
    joined = left.join(right, reduce(Column.__and__, same), "left").drop(*other.values())
    return joined.select(*keys, *within, *[c for c in joined.columns if c not in other])


# Rows of one right-side key above which the key is salted; a session can override it with
# the setting ``erpweave.hotKeyRows`` (roughly the rows one task should join per key).
HOT_KEY_ROWS = 1_000_000
MIN_HOT_KEY_ROWS = 100  # floor of the session setting
MAX_HOT_KEYS = 4_096
HOT_KEY_ROWS_CONF = "erpweave.hotKeyRows"
_BUCKETS = "__erpweave_buckets"
_SALT = "__erpweave_salt"
_MATCHED = "__erpweave_matched"
_MASTER, _MASTERS = "__erpweave_master", "__erpweave_masters"


def hot_keys(right: DataFrame, keys: list[str], hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys with more than ``hot_key_rows`` right rows (the hottest ones), with their bucket count."""
    counted = (
        right.select(*keys)
        .filter(~any_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .filter(F.col("__rows") > hot_key_rows)
        .orderBy(F.col("__rows").desc(), *keys)
        .limit(MAX_HOT_KEYS)
    )
    return counted.select(*keys, F.ceil(F.col("__rows") / F.lit(hot_key_rows)).cast("int").alias(_BUCKETS))


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    spread_null_keys: bool = False,
    split_right_skew: bool = False,
    hot_key_rows: int | None = None,
    counted: DataFrame | None = None,
    within: Sequence[str] = (),
    nulls_match: Sequence[str] = (),
) -> DataFrame:
    """``left LEFT JOIN right USING (on)``: keys first, then left's and right's other columns.

    ``spread_null_keys``: use when the left keys may be null (e.g. they come from an
    earlier outer join). ``split_right_skew``: use when one key may hold a large share of
    the right side's rows (one-to-many joins, copies); see the module notes. ``counted``: the
    rows whose keys are counted for that, where ``right`` is a join that should not run twice.
    ``within``: further keys, compared among the rows that are equal in ``on``. Both sides are
    shuffled by ``on`` alone, so rows that lie by ``on`` already stay where they are; use it where
    an ``on`` has few rows (every left row of one meets every right row of it). ``nulls_match``:
    those of ``within`` whose nulls match each other.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if within:
        if spread_null_keys or split_right_skew:
            msg = "within goes with neither spread_null_keys nor split_right_skew"
            raise ValueError(msg)
        return _join_within(left, right, keys, list(within), nulls_match)
    if not split_right_skew:
        return _join(left, right, keys, "left", spread_null_keys)
    hot = _hot(right if counted is None else counted, keys, hot_key_rows)
    return _join_salted(_salted(left, hot, keys), right, hot, keys, spread_null_keys)


def _hot(right: DataFrame, keys: list[str], hot_key_rows: int | None) -> DataFrame:
    """The hot keys as a broadcast table (at most ``MAX_HOT_KEYS``)."""
    if hot_key_rows is None:
        hot_key_rows = max(MIN_HOT_KEY_ROWS, int(right.sparkSession.conf.get(HOT_KEY_ROWS_CONF, str(HOT_KEY_ROWS))))
    return F.broadcast(hot_keys(right, keys, hot_key_rows))


def _salted(left: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Each left row once per bucket of its key (cold keys: one copy with salt 0)."""
    return left.join(hot, on=keys, how="left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_BUCKETS), F.lit(1)) - 1))
    )


def _join_salted(salted_left: DataFrame, right: DataFrame, hot: DataFrame, keys: list[str], spread: bool = False) -> DataFrame:
    buckets = F.col(_BUCKETS)
    # Each right row in one bucket of its key, picked by a hash of the row; a marker
    # tells matched output rows from unmatched ones.
    salted_right = (
        right.join(hot, on=keys, how="left")
        .withColumn(
            _SALT,
            F.when(buckets.isNull(), F.lit(0)).otherwise(F.pmod(_row_hash(right), buckets)).cast("int"),
        )
        .drop(_BUCKETS)
        .withColumn(_MATCHED, F.lit(True))
    )
    joined = _join(salted_left, salted_right, [*keys, _SALT], "left", spread)
    # A hot key has partners in some bucket, so its copies that met an empty bucket are
    # surplus; cold rows keep left-join semantics.
    kept = joined.filter(buckets.isNull() | F.col(_MATCHED).isNotNull())
    return kept.drop(_SALT, _BUCKETS, _MATCHED)


def _salted_with_masters(headers: DataFrame, masters: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """``headers LEFT JOIN masters`` as ``_salted`` gives it, with each moved once: both go by key and
    salt as one table, and a window hands a key's masters (few, the key is theirs) to its headers."""
    master = F.struct(*[c for c in masters.columns if c not in keys]).alias(_MASTER)
    # Masters of no key match no header.
    both = headers.unionByName(masters.dropna(subset=keys).select(*keys, master), allowMissingColumns=True)
    group = Window.partitionBy(*keys, _SALT)
    found = _salted(both, hot, keys).withColumn(_MASTERS, F.collect_list(_MASTER).over(group)).filter(F.isnull(_MASTER))
    columns = [*headers.columns, _BUCKETS, _SALT]
    return found.select(*columns, F.explode_outer(_MASTERS).alias(_MASTER)).select(*columns, f"{_MASTER}.*")


# The contract's joined columns; its last four are derived afterwards.
LOCAL_MATERIAL_COLUMNS = names(LOCAL_MATERIAL_CONTRACT)[:15]


def integration_local_material(
    sap_mara: DataFrame,
    sap_mbew: DataFrame,
    sap_marc: DataFrame,
    sap_t001k: DataFrame,
    sap_t001w: DataFrame,
    sap_t001: DataFrame,
    extra_keys: Sequence[str] = (),
    origin: str | None = None,
) -> DataFrame:
    """Plant materials with material, plant, valuation, area and company data.

    MARC ⟕ MARA (MATNR) ⟕ T001W (MANDT, WERKS) ⟕ MBEW (MANDT, MATNR, BWKEY)
    ⟕ T001K (MANDT, BWKEY) ⟕ T001 (MANDT, BUKRS), then the 15 output columns.
    ``extra_keys`` (e.g. a system column present on every input) is added to every join
    so that equal numbers from different systems do not match each other. ``origin`` names a
    column of every input that tells its system: ``FOREIGN`` then counts the joined rows whose
    origin is another one than the plant's. It is added up after each join, so the next
    shuffle carries the plant's origin and one number, however many tables are joined.
    """
    require_named_dataframes(
        sap_mara=sap_mara, sap_mbew=sap_mbew, sap_marc=sap_marc, sap_t001k=sap_t001k, sap_t001w=sap_t001w, sap_t001=sap_t001
    )
    extra = list(extra_keys)
    # Materials and valuations are joined by material, the other keys compared within it: the
    # rows stay partitioned by MATNR through both joins (and the final window, whose key holds
    # it). MARA has few rows per material, MBEW at most one per area and system after its top-1,
    # and MARC one per plant, so a material's rows are bounded by the organisation.
    # MANDT and BUKRS come from the right side of earlier joins: spread their null keys where they
    # are shuffled by. Plants, areas and company codes are organisational tables that do not grow
    # with the transactions: no right side needs splitting. Areas hang off the plants alone (BWKEY
    # is T001W's), so a plant brings its areas along: where plants are too many to be broadcast, the
    # rows go by plant and back by material, and what MBEW and the areas fan out stays there. To the
    # plants they take the clients of their material alone, each once; MARA's rows are joined when
    # they are back.
    plants = _plants_with_areas(sap_t001w, sap_t001k, extra, origin)
    clients = sap_mara.select("MATNR", "MANDT", *extra).repartition("MATNR").distinct()
    joined = left_join(sap_marc, clients, "MATNR", within=extra)
    joined = _join_counting(joined, plants, [*extra, "MANDT", "WERKS"], origin, spread_null_keys=True)
    # A row of no client is one of a material that MARA has without a client or not at all.
    joined = _join_counting(joined, sap_mara, ["MATNR"], origin, within=["MANDT", *extra], nulls_match=["MANDT"])
    # The area first: of the compared keys it tells most rows of a material apart.
    joined = _join_counting(joined, sap_mbew, ["MATNR"], origin, within=["BWKEY", "MANDT", *extra])
    joined = joined.select(*[c for c in joined.columns if c != _AREAS], F.explode_outer(_AREAS).alias(_AREAS))
    joined = _counting(joined.select(*[c for c in joined.columns if c != _AREAS], f"{_AREAS}.*"), origin)
    joined = _join_counting(joined, sap_t001, [*extra, "MANDT", "BUKRS"], origin, spread_null_keys=True)
    return joined.select(*LOCAL_MATERIAL_COLUMNS, *extra, *([FOREIGN] if origin else []))


def _plants_with_areas(sap_t001w: DataFrame, sap_t001k: DataFrame, extra: list[str], origin: str | None) -> DataFrame:
    """T001W with an array of T001K's rows of the same client and valuation area, found by one
    grouping: the result of a join counts as the product of both sizes where Spark decides on a
    broadcast, that of a grouping as their sum."""
    keys = [*extra, "MANDT", "BWKEY"]
    plant = F.struct(*[c for c in sap_t001w.columns if c not in keys])
    area = F.struct("BUKRS", *([F.col(origin).alias(_ORIGIN)] if origin else []))
    # Plants of no client or area match nothing and stay in groups of their own.
    plants = sap_t001w.select(*keys, _spread_column(sap_t001w, keys, True).alias(_SPREAD), plant.alias("plant"))
    areas = sap_t001k.dropna(subset=keys).select(*keys, F.lit(0).cast("long").alias(_SPREAD), area.alias("area"))
    return (
        plants.unionByName(areas, allowMissingColumns=True)
        .groupBy(*keys, _SPREAD)
        .agg(F.collect_list("plant").alias("plants"), F.collect_list("area").alias(_AREAS))
        .select(*keys, F.explode("plants").alias("plant"), _AREAS)
        .select(*keys, "plant.*", _AREAS)
    )


def _join_counting(left: DataFrame, right: DataFrame, keys: list[str], origin: str | None, **options) -> DataFrame:
    """Left join that adds 1 to ``FOREIGN`` where the right row's ``origin`` is not the left row's."""
    if origin is None:
        return left_join(left, right, keys, **options)
    return _counting(left_join(left, right.withColumnRenamed(origin, _ORIGIN), keys, **options), origin)


def _counting(joined: DataFrame, origin: str | None) -> DataFrame:
    """``FOREIGN`` with the joined row's origin (``_ORIGIN``) counted."""
    if origin is None:
        return joined
    other = F.coalesce((F.col(_ORIGIN) != F.col(origin)).cast("int"), F.lit(0))
    before = F.col(FOREIGN) if FOREIGN in joined.columns else F.lit(0)
    return joined.withColumn(FOREIGN, before + other).drop(_ORIGIN)


def integration_process_order(
    sap_afko: DataFrame,
    sap_afpo: DataFrame,
    sap_aufk: DataFrame,
    sap_mara: DataFrame,
    sap_cdpos: DataFrame | None = None,
    extra_keys: Sequence[str] = (),
    hot_key_rows: int | None = None,
) -> DataFrame:
    """Order headers with items, order master, material and (optionally) change items.

    AFKO ⟕ AFPO (AUFNR) ⟕ AUFK (AUFNR) ⟕ MARA (MATNR) [⟕ CDPOS (OBJNR)], then
    ``ZZGLTRP_ORIG := coalesce(ZZGLTRP_ORIG, GLTRP)``.
    """
    require_named_dataframes(sap_afko=sap_afko, sap_afpo=sap_afpo, sap_aufk=sap_aufk, sap_mara=sap_mara)
    require_optional_dataframe(sap_cdpos, "sap_cdpos")
    extra = list(extra_keys)
    # MATNR comes from the items and OBJNR from the order masters alone, so materials are joined
    # to the items and changes to the masters, before either meets the headers: the rows are
    # those of the chain, the shuffles by MATNR and OBJNR move narrow rows, and the wide rows
    # are never moved. They stay in the order of their order numbers, of which a file repeats
    # few values.
    # Items and change items are one-to-many right sides that may hold a hot key (one order
    # with most items): split it. The order master is joined before the items: both hang off
    # the header's AUFNR, so the order of the two left joins does not change the rows, and the
    # re-partitioning between them then moves header rows rather than item rows.
    items = left_join(sap_afpo, sap_mara, [*extra, "MATNR"], spread_null_keys=True)
    order = [*extra, "AUFNR"]
    change = [*extra, "OBJNR"]
    # Changes of order masters; where the masters have no OBJNR, changes are joined last.
    of_masters = sap_cdpos is not None and "OBJNR" in sap_aufk.columns
    if of_masters:
        changed = left_join(
            sap_aufk, sap_cdpos, change, spread_null_keys=True, split_right_skew=True, hot_key_rows=hot_key_rows
        )
        # An order is hot here by its changes.
        counted = sap_aufk.select(*order, "OBJNR").join(sap_cdpos.select(*change), change)
        joined = left_join(sap_afko, changed, order, split_right_skew=True, hot_key_rows=hot_key_rows, counted=counted)
    elif sap_afko.isStreaming:
        joined = left_join(sap_afko, sap_aufk, order)
    if of_masters or sap_afko.isStreaming:
        joined = left_join(joined, items, order, split_right_skew=True, hot_key_rows=hot_key_rows, counted=sap_afpo)
    else:
        # Headers and masters take the salt of the items together and are not moved again.
        hot = _hot(sap_afpo, order, hot_key_rows)
        joined = _join_salted(_salted_with_masters(sap_afko, sap_aufk, hot, order), items, hot, order)
    if sap_cdpos is not None and not of_masters:
        joined = left_join(joined, sap_cdpos, change, spread_null_keys=True, split_right_skew=True, hot_key_rows=hot_key_rows)
    return _finished_order_rows(joined, sap_afko, sap_afpo, sap_aufk, sap_mara, sap_cdpos, extra)


def order_rows_with_materials(
    joined: DataFrame,
    sap_afko: DataFrame,
    sap_afpo: DataFrame,
    sap_aufk: DataFrame,
    sap_mara: DataFrame,
    sap_cdpos: DataFrame | None = None,
    extra_keys: Sequence[str] = (),
    hot_key_rows: int | None = None,
) -> DataFrame:
    """The rows of :func:`integration_process_order` where ``joined`` holds J6 and J7 already."""
    extra = list(extra_keys)
    # MATNR and OBJNR come from the right side of earlier joins: spread their null keys.
    joined = left_join(joined, sap_mara, [*extra, "MATNR"], spread_null_keys=True)
    if sap_cdpos is not None:
        joined = left_join(
            joined, sap_cdpos, [*extra, "OBJNR"], spread_null_keys=True, split_right_skew=True, hot_key_rows=hot_key_rows
        )
    return _finished_order_rows(joined, sap_afko, sap_afpo, sap_aufk, sap_mara, sap_cdpos, extra)


def _finished_order_rows(
    joined: DataFrame,
    sap_afko: DataFrame,
    sap_afpo: DataFrame,
    sap_aufk: DataFrame,
    sap_mara: DataFrame,
    sap_cdpos: DataFrame | None,
    extra: list[str],
) -> DataFrame:
    """The columns in the order of the chain of joins, and the coalesced original date."""
    steps = [(sap_afpo, "AUFNR"), (sap_aufk, "AUFNR"), (sap_mara, "MATNR")]
    if sap_cdpos is not None:
        steps.append((sap_cdpos, "OBJNR"))
    joined = joined.select(*_using_order(sap_afko.columns, steps, extra))
    return joined.withColumn("ZZGLTRP_ORIG", F.coalesce(F.col("ZZGLTRP_ORIG"), F.col("GLTRP")))


def _using_order(first: list[str], steps: list[tuple[DataFrame, str]], extra: list[str]) -> list[str]:
    """Column order of the chain ``first ⟕ step1 ⟕ step2 ...`` joined with ``USING``:
    each join's keys lead, then the left columns, then the right side's other columns."""
    order = list(first)
    for right, key in steps:
        keys = [*extra, key]
        order = keys + [c for c in order if c not in keys] + [c for c in right.columns if c not in keys]
    return order
