"""Resolve free region names to a list of known regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiweave.fixed import MIN_CONTAINED_NAME, REGION_ALIASES
from epiweave.functions.text import harmonize, match_key
from epiweave.session import materialize


BLOCK_CHARS = 1024
HEAD = 64


def region_key(col: Column | str, aliases: dict[str, str] = REGION_ALIASES) -> Column:
    return harmonize(match_key(col), aliases)


def _pieces(outer: DataFrame, longest: Column | int) -> DataFrame:
    """(id, _at, _piece): the text of up to ``longest`` characters at each position of each row's ``text``. A text is cut into overlapping
    blocks first, so that no row of a step is larger than a block."""
    rows = outer.withColumn("_longest", longest if isinstance(longest, Column) else F.lit(longest)).where("_longest > 0")
    blocks = rows.select("id", "_longest", "text", F.explode(F.expr(f"sequence(0, (length(text) - 1) div {BLOCK_CHARS})")).alias("_block"))
    blocks = blocks.select("id", "_longest", "_block", F.expr(f"substring(text, int(_block * {BLOCK_CHARS} + 1), {BLOCK_CHARS} + _longest - 1) as _part"))
    places = blocks.select("id", "_longest", "_block", "_part", F.explode(F.expr(f"sequence(1, least({BLOCK_CHARS}, length(_part)))")).alias("_start"))
    return places.select("id", F.expr(f"_block * {BLOCK_CHARS} + _start as _at"), F.expr("substring(_part, _start, _longest) as _piece"))


def contained(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """Distinct (id, part), ids being short: the texts ``part`` of ``inner`` that stand in the ``text`` of each row of ``outer`` (id, text); stored tables both.

    Pieces are cut only to lengths that occur among the parts, so a long text costs in proportion to its length. Parts of more
    than ``HEAD`` characters are looked up by their beginning, and what is found is compared as a whole.
    """
    short = inner.where(F.length("part") <= HEAD)
    lengths = short.select(F.length("part").alias("n")).distinct().agg(F.array_sort(F.collect_list("n"))).scalar()
    pieces = _pieces(outer, F.coalesce(F.array_max(lengths), F.lit(0))).withColumn("_lengths", lengths)
    cut = pieces.select("id", "_piece", F.explode(F.expr("filter(_lengths, n -> n <= length(_piece))")).alias("_n"))
    found = cut.select("id", F.expr("substring(_piece, 1, _n) as part")).join(short, "part").select("id", "part").distinct()
    heads = inner.where(F.length("part") > HEAD).select("part", F.substring("part", 1, HEAD).alias("_piece"))
    if heads.isEmpty():
        return found
    begun = _pieces(outer.where(F.length("text") > HEAD), HEAD).join(heads, "_piece").select("id", "_at", "part")
    whole = begun.join(outer, "id").where("substring(text, int(_at), length(part)) = part")
    return found.unionByName(whole.select("id", "part").distinct())


def resolve_names(
    names: DataFrame,
    known: DataFrame,
    name: str = "nombre",
    region: str = "departamento",
    aliases: dict[str, str] = REGION_ALIASES,
    shortest: int = MIN_CONTAINED_NAME,
) -> DataFrame:
    """Best known region of each distinct name: (name, region, how), region null if none.

    The same comparison key after aliases wins. Otherwise one key must contain the other and
    the contained one must have at least ``shortest`` characters; the longest contained key
    wins, then the region's name. Containment is found by equality on substrings of one side, cut only
    to lengths that occur on the other side, so a long name or region costs in proportion to its length. Names
    times regions never meet, and each substring leads to one region, so the joins cannot
    multiply rows.
    """
    wanted = materialize(
        names.select(F.col(name).alias("name")).where(F.col(name).isNotNull()).distinct()
        .withColumns({"name_key": region_key("name", aliases), "name_plain": match_key("name")})
        .withColumn("name_id", F.sha2("name", 256)), "names",
    )
    regions = materialize(
        known.select(F.col(region).alias("region")).where(F.col(region).isNotNull()).distinct()
        .withColumns({"region_key": region_key("region", aliases), "region_plain": match_key("region"), "region_id": F.sha2("region", 256)}), "regions",
    )
    by_key = regions.where(F.col("region_key") != "").groupBy(F.col("region_key").alias("name_key")).agg(
        F.min("region").alias("exact")
    )
    by_plain = regions.where(F.length("region_plain") >= shortest).groupBy("region_plain").agg(
        F.min("region").alias("inner_region")
    )
    parts = wanted.where(F.length("name_plain") >= shortest).select(F.col("name_plain").alias("part")).distinct()
    by_part = (
        contained(regions.select(F.col("region_id").alias("id"), F.col("region_plain").alias("text")), parts)
        .join(regions.select(F.col("region_id").alias("id"), "region"), "id")
        .groupBy("part").agg(F.min("region").alias("outer_region"))
    )
    # Regions named inside the name; a name of fewer characters has no such part.
    inner = (
        contained(wanted.select(F.col("name_id").alias("id"), F.col("name_plain").alias("text")), by_plain.select(F.col("region_plain").alias("part")))
        .join(by_plain, F.col("part") == F.col("region_plain"))
        .groupBy(F.col("id").alias("name_id"))
        .agg(F.min_by("inner_region", F.struct(-F.length("region_plain"), "inner_region")).alias("inner_region"))
    )
    found = (
        wanted.join(by_key, "name_key", "left")
        .join(by_part, F.col("name_plain") == F.col("part"), "left")
        .join(inner, "name_id", "left")
    )
    return found.select(
        F.col("name").alias(name),
        F.coalesce("exact", "outer_region", "inner_region").alias(region),
        F.when(F.col("exact").isNotNull(), "exact")
        .when(F.coalesce("outer_region", "inner_region").isNotNull(), "contained")
        .alias("how"),
    )
