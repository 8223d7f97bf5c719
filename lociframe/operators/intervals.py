"""Interval operators. Coordinates are 0-based half-open; `keys` (chromosome, sample, strand) hold positions together.

Nothing here sorts or joins a whole chromosome in one task: joins are equi-joins on bins, sums run inside tiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

TILE = 100_000
#: A row that would fall into more bins than this is joined on a coarser level of bins.
SPREAD = 64
#: The coarsest level; its bins are SPREAD ** LEVELS times as wide as the first.
LEVELS = 2
#: So many bins of the first level are a tile, where whole rows meet a tile's features, and sums run along the bases.
CELL = 16
#: A tile's features are looked up by so many parts of it.
STEPS = 64


def _bins(start: Column, end: Column, width: Column) -> Column:
    return F.sequence(F.floor(start / width), F.floor((end - 1) / width))


def _levels(df: DataFrame, start: str, end: str, width: int) -> Column:
    """The first level on which the row crosses at most SPREAD bins, or the coarsest."""
    size = (F.col(end) - F.col(start)).cast("double") / width
    level = F.lit(0)
    for k in range(1, LEVELS + 1):
        level = F.when(size > SPREAD**k, k).otherwise(level)
    return level


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int = 1000, l_start: str = "s", l_end: str = "e", r_start: str = "s2", r_end: str = "e2", build: bool = False) -> DataFrame:
    """All pairs of rows that agree in `keys` and share a base, with `overlap` in bases; column names must differ else.

    A row is exploded to the bins it touches on its own level, where these are few, and as a guest to the one or two bins
    of each coarser level. Own rows meet own rows and guests, guests never meet guests, so a pair of short rows is only
    looked at in the fine bins it shares; guests of the left side stand only on levels where the right side has rows of
    its own. A pair is reported in the one bin that holds the first shared base. Hot bins are left to adaptive skew joins.
    Empty intervals match none. `build` says that the right side is an annotation, far smaller than the left one: its part of
    a task is held in memory, and the left side streams by unsorted.
    """
    # how a row takes part: own row that meets own rows, own row that meets guests, guest
    plain, host, guest = 0, 1, 2

    def binned(df: DataFrame, start: str, end: str, as_host: int, as_guest: int, levels: DataFrame | None = None) -> DataFrame:
        rows = df.where(F.col(start) < F.col(end)).withColumn("__own", _levels(df, start, end, width))
        parts = F.transform(F.sequence(F.col("__own"), F.lit(LEVELS)), lambda x: F.struct(x.alias("level"), F.when(x > F.col("__own"), as_guest).otherwise(plain).alias("kind")))
        hosts = F.when(F.col("__own") > 0, F.array(F.struct(F.col("__own").alias("level"), F.lit(as_host).alias("kind"))))
        parts = F.concat(parts, F.coalesce(hosts, F.array().cast("array<struct<level:int,kind:int>>")))
        rows = rows.select(*df.columns, F.inline(parts).alias("__level", "__kind"))
        if levels is not None:  # a row for each level and kind at most
            free = df.sparkSession.range(LEVELS + 1).select(F.col("id").cast("int").alias("__level"), F.explode(F.array(F.lit(plain), F.lit(as_host))).alias("__kind"))
            here = free.unionByName(levels.distinct().withColumn("__kind", F.lit(as_guest)))
            rows = rows.join(F.broadcast(here), ["__level", "__kind"], "left_semi")
        wide = F.lit(width) * F.pow(F.lit(SPREAD), F.col("__level"))
        return rows.withColumn("__bin", F.explode(_bins(F.col(start), F.col(end), wide)))

    own = right.where(F.col(r_start) < F.col(r_end)).select(_levels(right, r_start, r_end, width).alias("__level"))
    a = binned(left, l_start, l_end, host, guest, own)
    b = binned(right, r_start, r_end, guest, host)
    low, high = F.greatest(l_start, r_start), F.least(l_end, r_end)
    met = (low < high) & (F.col("__bin") == F.floor(low / (F.lit(width) * F.pow(F.lit(SPREAD), F.col("__level")))))
    b = b.hint("shuffle_hash") if build else b
    return a.join(b, [*keys, "__level", "__kind", "__bin"]).where(met).withColumn("overlap", high - low).drop("__level", "__kind", "__bin")


def packed(blocks: Column) -> tuple[Column, Column, Column]:
    """(base, near, far) of an array of s, e: where the first block starts, and start from there and length of each block, as small
    integers if all of them are such, else as large ones."""
    base = F.try_element_at(blocks, F.lit(1)).s.cast("bigint")
    numbers = F.flatten(F.transform(blocks, lambda b: F.array(b.s - base, (b.e - b.s).cast("bigint"))))
    small = F.coalesce(F.forall(numbers, lambda x: x.between(-(1 << 15), (1 << 15) - 1)), F.lit(False))
    return base, F.when(small, numbers.cast("array<smallint>")), F.when(~small, numbers)


def tiled_overlaps(rows: DataFrame, features: DataFrame, keys: list[str], names: list[str], width: int = 1000, among: Column | None = None, apart: Sequence[str] = ()) -> DataFrame:
    """rows (keys, blocks: array of s, e, and more) with `met`: an array of the features (keys, s2, e2, names) that share bases
    with the blocks, as names and `overlap`, once for each tile of CELL * width bases that a row touches; `whole` says that
    the row touches one only, so that `met` has all of its features, and that `among` holds, if given. Rows that meet nothing
    are left out. The columns in `apart` are what rows that are not whole are put together by, and null in whole ones.

    A tile's features are one row, so a row is shuffled once for each of its tiles, not for each bin of each block, and what
    it meets comes with it. A feature that crosses more than SPREAD tiles stands on a coarser level, and a row on every level
    that has features. A tile's features are held in memory, the rows stream by unsorted, their blocks packed.
    """
    tile = CELL * width
    own = features.where(F.col("s2") < F.col("e2")).withColumn("__level", _levels(features, "s2", "e2", tile))
    size = lambda level: F.lit(tile).cast("bigint") * F.pow(F.lit(SPREAD), level).cast("bigint")
    here = own.select(*keys, "__level", F.explode(_bins(F.col("s2"), F.col("e2"), size(F.col("__level")))).alias("__tile"), F.struct("s2", "e2", *names).alias("__x"))
    here = here.groupBy(*keys, "__level", "__tile").agg(F.sort_array(F.collect_list("__x")).alias("__here"))
    # by steps of the tile: the first feature that ends behind the step's start, and how many start before its end
    at = lambda x: (x.cast("bigint") - F.col("__tile") * size(F.col("__level"))) * STEPS
    steps = F.sequence(F.lit(0).cast("bigint"), F.lit(STEPS - 1).cast("bigint"))
    first = lambda i: F.array_position(F.transform("__here", lambda x: at(x.e2) > i * size(F.col("__level"))), True)
    here = here.withColumn("__from", F.transform(steps, lambda i: F.when(first(i) > 0, first(i)).otherwise(F.size("__here") + 1).cast("int")))
    here = here.withColumn("__to", F.transform(steps, lambda i: F.size(F.filter("__here", lambda x: at(x.s2) < (i + 1) * size(F.col("__level"))))))
    levels = own.select("__level").distinct().agg(F.collect_list("__level").alias("__levels"))  # one row, of three levels at most

    def tiles(level: Column) -> Column:
        touched = F.transform(F.filter("blocks", lambda b: b.s < b.e), lambda b: _bins(b.s, b.e, size(level)))
        return F.transform(F.array_distinct(F.flatten(touched)), lambda t: F.struct(level.alias("level"), t.alias("tile")))

    more = [c for c in rows.columns if c not in (*keys, "blocks")]
    placed = rows.crossJoin(F.broadcast(levels)).withColumn("__tiles", F.flatten(F.transform("__levels", tiles))).drop("__levels")
    placed = placed.withColumn("whole", (F.size("__tiles") == 1) & (among if among is not None else F.lit(True)))
    placed = placed.withColumns({c: F.when(~F.col("whole"), F.col(c)) for c in apart})
    base, near, far = packed(F.col("blocks"))
    placed = placed.select(*keys, *more, "whole", base.alias("__base"), near.alias("__near"), far.alias("__far"), F.inline("__tiles").alias("__level", "__tile"))
    joined = placed.join(here.hint("shuffle_hash"), [*keys, "__level", "__tile"])
    # generated, not projected: Spark would put a projection's expressions into the functions below, once for every feature
    once = lambda df, **columns: df.select("*", F.inline(F.array(F.struct(*[x.alias(c) for c, x in columns.items()]))))
    numbers = lambda i: F.element_at("__numbers", i.cast("int"))
    # of the tile's features, only those about the row's blocks go on
    step = lambda pos: F.floor(pos * STEPS / size(F.col("__level"))) + 1
    place = F.col("__base") - F.col("__tile") * size(F.col("__level"))
    known = F.coalesce(F.col("__near").cast("array<bigint>"), F.col("__far"))
    starts = lambda n: F.filter(n, lambda x, i: i % 2 == 0)
    ends = lambda n: F.transform(F.sequence(F.lit(1), (F.size(n) / 2).cast("int")), lambda i: F.element_at(n, 2 * i - 1) + F.element_at(n, 2 * i))
    low_step = lambda n: step(F.greatest(place + F.array_min(starts(n)), F.lit(0))).cast("int")
    high_step = lambda n: F.least(step(place + F.array_max(ends(n)) - 1), F.lit(STEPS)).cast("int")
    near_by = lambda n: F.transform(F.array(F.element_at("__from", low_step(n))), lambda k: F.slice("__here", k, F.greatest(F.element_at("__to", high_step(n)) - k + 1, F.lit(0))))
    joined = once(joined, __beside=F.element_at(F.flatten(F.transform(F.array(known), near_by)), 1)).drop("__here", "__from", "__to")
    joined = once(joined, __numbers=known)
    start = lambda i: F.col("__base") + numbers(2 * i + 1)
    blocks = F.transform(F.sequence(F.lit(0), (F.size("__numbers") / 2 - 1).cast("int")), lambda i: F.struct(start(i).alias("s"), (start(i) + numbers(2 * i + 2)).alias("e")))
    joined = once(joined, blocks=blocks.cast(rows.schema["blocks"].dataType))
    low, high = F.array_min(F.col("blocks.s")), F.array_max(F.col("blocks.e"))
    joined = once(joined, __low=F.greatest(low, F.col("__tile") * size(F.col("__level"))), __high=F.least(high, (F.col("__tile") + 1) * size(F.col("__level"))))
    shared = lambda x: F.aggregate("blocks", F.lit(0).cast("bigint"), lambda n, b: n + F.greatest(F.least(b.e, x.e2, F.col("__high")) - F.greatest(b.s, x.s2, F.col("__low")), F.lit(0)).cast("bigint"))
    beside = F.filter("__beside", lambda x: (x.s2 < F.col("__high")) & (x.e2 > F.col("__low")))
    met = F.filter(F.transform(beside, lambda x: F.struct(*[x[n].alias(n) for n in names], shared(x).alias("overlap"))), lambda y: y.overlap > 0)
    return joined.select(*rows.columns, "whole", met.alias("met")).where(F.size("met") > 0)


def merge_intervals(df: DataFrame, keys: list[str], start: str = "s", end: str = "e", tile: int = TILE) -> DataFrame:
    """Unions of intervals that overlap or touch; an empty interval counts as its place, one that ends before it starts is
    left out.

    Intervals are cut at tile edges and merged inside each tile; only runs that reach a tile edge, two a tile at most, are
    put together afterwards.
    """
    first, last = F.floor(F.col(start) / tile), F.floor(F.greatest(F.col(end) - 1, F.col(start)) / tile)
    cut = df.where(F.col(start) <= F.col(end)).select(*keys, start, end, F.explode(F.sequence(first, last)).alias("__tile"))
    cut = cut.withColumn(start, F.greatest(F.col(start), F.col("__tile") * tile)).withColumn(end, F.least(F.col(end), (F.col("__tile") + 1) * tile))

    def runs(rows: DataFrame, within: list[str]) -> DataFrame:
        order = Window.partitionBy(*within).orderBy(start, end)
        before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
        marked = rows.withColumn("__new", F.when(F.col(start) <= before, 0).otherwise(1))
        numbered = marked.withColumn("__no", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        return numbered.groupBy(*within, "__no").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__no")

    inside = runs(cut, [*keys, "__tile"])
    at_edge = (F.col(start) == F.col("__tile") * tile) | (F.col(end) == (F.col("__tile") + 1) * tile)
    return inside.where(~at_edge).select(*keys, start, end).unionByName(runs(inside.where(at_edge).drop("__tile"), keys))


def coverage(df: DataFrame, keys: list[str], start: str = "s", end: str = "e", weight: Column | float = 1.0, tile: int = TILE, least: float = 1e-9) -> DataFrame:
    """keys, s, e, value: total weight between neighbouring interval ends, where it exceeds `least`.

    Intervals are cut at tile edges and summed inside each tile; a segment that only a tile edge ended is joined to its
    neighbour. Ends of intervals always end a segment.
    """
    w = weight if isinstance(weight, Column) else F.lit(float(weight))
    rows = df.where(F.col(start) < F.col(end)).select(*keys, F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e"), w.alias("w"))
    cut = rows.withColumn("t", F.explode(_bins(F.col("s"), F.col("e"), F.lit(tile)).cast("array<bigint>")))
    cut = cut.select(*keys, "t", F.greatest("s", F.col("t") * tile).alias("a"), F.least("e", (F.col("t") + 1) * tile).alias("b"), "s", "e", "w")
    edges = F.array(
        F.struct(F.col("a").alias("pos"), F.col("w").alias("d"), (F.col("a") == F.col("s")).cast("int").alias("real")),
        F.struct(F.col("b").alias("pos"), (-F.col("w")).alias("d"), (F.col("b") == F.col("e")).cast("int").alias("real")),
    )
    events = cut.select(*keys, "t", F.explode(edges).alias("x")).groupBy(*keys, "t", "x.pos").agg(F.sum("x.d").alias("d"), F.max("x.real").alias("real"))
    order = Window.partitionBy(*keys, "t").orderBy("pos")
    level = F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))
    parts = events.withColumn("value", level).withColumn("e", F.lead("pos").over(order)).withColumn("end_real", F.lead("real").over(order)).where((F.col("value") > least) & F.col("e").isNotNull())
    parts = parts.select(*keys, "t", F.col("pos").alias("s"), "e", "value", "real", "end_real")
    # a part that begins at a tile edge where no interval ends continues the last part of the tile before
    whole = Window.partitionBy(*keys).orderBy("s")
    edge = (F.col("s") % tile == 0) & (F.col("real") == 0)
    plain, at_edge = parts.where(~(edge | (F.col("e") % tile == 0))), parts.where(edge | (F.col("e") % tile == 0))
    joined = at_edge.withColumn("__new", F.when((F.col("s") % tile == 0) & (F.col("real") == 0) & (F.lag("e").over(whole) == F.col("s")) & (F.lag("end_real").over(whole) == 0), 0).otherwise(1))
    joined = joined.withColumn("__no", F.sum("__new").over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    joined = joined.groupBy(*keys, "__no").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min_by("value", "s").alias("value"))
    return plain.select(*keys, "s", "e", "value").unionByName(joined.select(*keys, "s", "e", "value"))


def binned_coverage(df: DataFrame, keys: list[str], width: int, start: str = "s", end: str = "e", weight: Column | float = 1.0) -> DataFrame:
    """keys, bin, value: weighted bases in a bin by the bin's width (a density; times width it is the sum)."""
    w = weight if isinstance(weight, Column) else F.lit(float(weight))
    rows = df.where(F.col(start) < F.col(end)).select(*keys, F.col(start).alias("s"), F.col(end).alias("e"), w.alias("w"))
    cut = rows.withColumn("bin", F.explode(_bins(F.col("s"), F.col("e"), F.lit(width)).cast("array<bigint>")))
    bases = F.least("e", (F.col("bin") + 1) * width) - F.greatest("s", F.col("bin") * width)
    return cut.groupBy(*keys, "bin").agg(F.sum(F.col("w") * bases / width).alias("value"))


def signal_in_regions(signal: DataFrame, regions: DataFrame, keys: list[str], region_id: str = "region_id", width: int = 1000) -> DataFrame:
    """region_id, signal: value times shared bases, summed (regions as s2, e2; signal as s, e, value); 0 without any."""
    met = overlap_join(signal, regions, keys, width, build=True).groupBy(region_id).agg(F.sum(F.col("value") * F.col("overlap")).alias("signal"))
    return regions.select(region_id).distinct().join(met, region_id, "left").select(region_id, F.coalesce("signal", F.lit(0.0)).alias("signal"))


def junctions_from_exons(exons: DataFrame, gene: str = "gene_id", chrom: str = "chrom") -> DataFrame:
    """gene, chrom, donor, acceptor: gaps between a gene's merged exons."""
    merged = merge_intervals(exons, [gene, chrom])
    order = Window.partitionBy(gene, chrom).orderBy("s")
    pairs = merged.select(gene, chrom, F.col("e").alias("donor"), F.lead("s").over(order).alias("acceptor"))
    return pairs.where(F.col("acceptor") > F.col("donor"))


def known_junction_match(fragments: DataFrame, junctions: DataFrame, blocks: str = "blocks", chrom: str = "chrom") -> DataFrame:
    """The fragments with a gap between neighbouring blocks that is a known junction (chrom, donor, acceptor)."""
    gaps = F.zip_with(F.slice(blocks, F.lit(1), F.size(blocks) - 1), F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0))), lambda a, b: F.struct(a.e.alias("donor"), b.s.alias("acceptor")))
    found = fragments.where(F.size(blocks) > 1).select("*", F.explode(gaps).alias("g"))
    found = found.select(*fragments.columns, F.col("g.donor").alias("donor"), F.col("g.acceptor").alias("acceptor"))
    known = junctions.select(chrom, "donor", "acceptor").distinct()
    return found.join(known, [chrom, "donor", "acceptor"], "left_semi").select(*fragments.columns).distinct()


def exclude_regions(regions: DataFrame, blacklist: DataFrame, keys: list[str], region_id: str = "region_id", width: int = 1000) -> DataFrame:
    """Regions (s, e) that share no base with a blacklisted one (s2, e2)."""
    hit = overlap_join(regions, blacklist.select(*keys, "s2", "e2"), keys, width).select(region_id).distinct()
    return regions.join(hit, region_id, "left_anti")


def scaled_profile(signal: DataFrame, regions: DataFrame, keys: list[str], bins: int = 20, group: str = "region_class", width: int = 1000) -> DataFrame:
    """group, bin, value: mean per-base signal over equal parts of each region (region_id, s2, e2, strand), 5' to 3',
    averaged over the group's regions; a part without signal counts 0. Regions shorter than `bins` are left out."""
    whole = regions.where(F.col("e2") - F.col("s2") >= bins).select("region_id", group, *keys, "strand", "s2", "e2")
    size = F.col("e2") - F.col("s2")
    edge = lambda i: F.floor(F.col("s2") + i * size / bins)
    # a stretch of signal meets whole regions, and is cut among the few parts that it lies in; the rest count 0
    met = overlap_join(signal, whole, keys, width, build=True)
    low, high = F.greatest("s", "s2"), F.least("e", "e2")
    part = lambda pos: F.floor((pos - F.col("s2")) * bins / size)
    touched = F.sequence(F.greatest(part(low) - 1, F.lit(0)), F.least(part(high) + 1, F.lit(bins - 1)))
    cut = met.select(group, "strand", "value", low.alias("__low"), high.alias("__high"), "s2", "e2", F.explode(touched).alias("i"))
    cut = cut.select(group, "strand", "value", "__low", "__high", "i", edge(F.col("i")).alias("__s"), edge(F.col("i") + 1).alias("__e"))
    shared = F.least("__high", "__e") - F.greatest("__low", "__s")
    bin_ = F.when(F.col("strand") == "-", bins - 1 - F.col("i")).otherwise(F.col("i")).cast("int").alias("bin")
    sums = cut.where(shared > 0).groupBy(group, bin_).agg(F.sum(F.col("value") * shared / (F.col("__e") - F.col("__s"))).alias("x"))
    counted = whole.groupBy(group).agg(F.count(F.lit(1)).alias("n")).select(group, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "n")
    both = counted.withColumn("x", F.lit(0.0)).unionByName(sums.select(group, "bin", F.lit(0).cast("bigint").alias("n"), "x"))
    return both.groupBy(group, "bin").agg((F.sum("x") / F.sum("n")).alias("value"))


def merge_tracks(keys: list[str], *tracks: DataFrame, tile: int = TILE) -> DataFrame:
    """One track from several (s, e, value): values add up."""
    union = tracks[0].select(*keys, "s", "e", "value")
    for track in tracks[1:]:
        union = union.unionByName(track.select(*keys, "s", "e", "value"))
    return coverage(union, keys, weight=F.col("value"), tile=tile)
