"""Place labels: which can be looked up, and which candidate of the gazetteers one is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.functions.geo import km
from pageloom.functions.names import place_head, place_tokens
from pageloom.functions.text import fold_gazetteer
from pageloom.operators.curation import context_support
from pageloom.operators.graph import settled

# Words a locality does not begin with, micro-localities, scraps that are no places.
PREPOSITIONS = "bei|beim|an|am|auf|im|in|hinter|vor|unter|über|zwischen|nahe|unweit|entlang|längs|gegen|ober|unterhalb|oberhalb|mit|nach|von|vom|zum|zur|zu|der|die|das|den|dem|des|ein|eine|einem|um|bis|durch|aus"
MICRO = r"garten|fenster|zimmer|terrasse|balkon|nistkasten|futterplatz|futterhaus|käfig|voliere|areal|vkl\.|k\d|w/\d|\bhaus\b|wohnung|dach|hof\b|straße|strasse|platz\b|weg\b|ecke\b"
GARBAGE = ("rauhfutter", "rauhhautm", "rauhhaut", "rauhsturm", "rauchturm")
BIG_CITY = ("PPLC", "PPLA", "PPLA2", "PPLA3")
# Categories and types of search hits that are places (strong) or named after one (weak), words of a name that tell nothing, and the order of feature classes beside a settlement and a natural feature.
STRONG_CATEGORIES = ("place", "natural", "waterway", "water", "mountain_pass")
STRONG = {
    "boundary": ("administrative", "protected_area", "national_park"),
    "leisure": ("nature_reserve", "park", "garden"),
    "landuse": ("reservoir", "forest", "meadow", "basin", "salt_pond", "quarry", "village_green", "allotments", "cemetery", "orchard", "farmyard"),
    "tourism": ("zoo", "viewpoint"),
    "historic": ("castle", "monastery"),
    "man_made": ("reservoir_covered",),
    "aeroway": ("aerodrome",),
}
WEAK_CATEGORIES = ("railway", "historic", "man_made", "tourism", "amenity", "aeroway", "building", "shop", "craft", "office", "information", "emergency", "club")
WEAK = {
    "highway": ("track", "path", "footway", "bridleway", "pedestrian"),
    "landuse": ("residential", "industrial", "farmland", "grass", "landfill"),
    "leisure": ("pitch", "playground", "sports_centre"),
    "power": ("plant",),
}
STOP_WORDS = (
    "naturschutzgebiet", "nsg", "landschaftsschutzgebiet", "schloss", "schlosspark", "bei", "am", "an", "der", "die",
    "das", "im", "in", "und", "ehem", "ehemalige", "ehemaliger", "gemeinde", "stadt", "markt", "ortsteil",
)
SETTLED_FIRST = {"P": 0, "A": 1, "S": 2, "L": 3, "H": 4, "T": 4, "V": 4}
NATURAL_FIRST = {"H": 0, "T": 0, "V": 0, "L": 0, "S": 2, "P": 3, "A": 4}


def rejection_reason(raw: Column, is_bird: Column) -> Column:
    """empty, garbage or bird; null for what may be a place. is_bird: whether the head is a bird's name."""
    head = place_head(raw)
    return (
        F.when(F.trim(F.coalesce(raw, F.lit(""))) == "", "empty")
        .when((F.length(head) < 3) | ~head.rlike("(?i)[aeiouyäöü]") | F.lower(head).isin(*GARBAGE), "garbage")
        .when(is_bird, "bird")
    )


def geocodable(label: Column, generic: tuple[str, ...] = ()) -> Column:
    """Whether a label could stand in a gazetteer at all. generic: folded common nouns that could not."""
    t = F.trim(F.coalesce(label, F.lit("")))
    key = fold_gazetteer(t)
    ok = F.length(t).between(3, 40) & (F.size(F.split(t, r"\s+")) <= 4) & ~t.rlike(rf"(?iU)^(?:{PREPOSITIONS})\b") & ~t.rlike(rf"(?iU)(?:{MICRO})") & ~t.rlike(r"[\d()\[\]/?!;:]") & t.rlike(r"^\p{Lu}")
    return ok & ~key.isin(*generic) & ~F.replace(key, F.lit(" "), F.lit("")).isin(*generic) if generic else ok


def base_score(c=F.col) -> Column:
    """Of a candidate before its context: agreement of both gazetteers, tier of the hit, relation of the names, kind of the feature."""
    osm = F.when(c("tier") == "strong", F.when(c("source") == "osm+geonames", 0.95).otherwise(0.85)).otherwise(0.6)
    osm = osm - F.when((c("kind") == "settlement") & ~c("category").isin("place", "boundary"), 0.15).otherwise(0.0)
    town = (c("fclass") == "P") & (c("population") >= 10000) & ~c("has_home")
    names = (
        F.when(c("name_tier") == "primary", F.when(c("is_home"), 0.7).when(c("cc").isin("DE", "AT", "CH"), 0.6).otherwise(0.5))
        .when(c("name_tier") == "contains", 0.55).when(town, 0.65).otherwise(0.4)
    )
    names = names - F.when(c("fclass") == "S", F.when(c("fcode").isin("RSTN", "ZOO", "CSTL", "PRK"), 0.05).otherwise(0.2)).when(c("fclass") == "A", 0.1).otherwise(0.0)
    return F.when(c("source") == "geonames", names).otherwise(osm)


def in_context(score: Column, c=F.col, far_km: float = 150.0) -> Column:
    """The score after the places of the same entries: near ones raise it, far ones lower it; big places that both gazetteers know keep it."""
    exempt = c("fcode").isin(*BIG_CITY) | (c("population") >= 20000)
    exempt = exempt & ((c("source") == "geonames") | ((c("source") == "osm+geonames") & (c("tier") == "strong")))
    near = (c("f_near") >= 0.2) | ((c("n_entries") <= 2) & (c("f_near") > 0))
    raised = F.when((c("tier") == "weak") & c("settlement_elsewhere"), score).otherwise(F.least(score + 0.3, F.lit(0.95)))
    lowered = F.when(F.coalesce(exempt, F.lit(False)) | (c("f_mid") >= 0.2), score).when(c("nearest_km") > far_km, score - 0.3).otherwise(score - 0.15)
    return F.when(c("n_entries") == 0, score).when(near, raised).otherwise(lowered)


def link_places(candidates: DataFrame) -> DataFrame:
    """label, id, source, confidence, status (linked, review, no_match) of each label's best candidate.

    candidates: label, id, source, tier, kind, category, name_tier, fclass, fcode,
    cc, population, lat, lon, is_home, has_home, settlement_elsewhere, and of the
    context n_entries, f_near, f_mid, nearest_km (0 and null without one).
    """
    scored = candidates.withColumn("score", in_context(base_score()))
    source = F.when(F.col("source") == "osm+geonames", 0).when(F.col("source") == "osm", 1).otherwise(2)
    kind = F.when(F.col("fclass") == "P", 0).when(F.col("fclass") == "A", 2).when(F.col("fclass") == "S", 3).otherwise(1)
    w = Window.partitionBy("label")
    rank = F.row_number().over(w.orderBy(F.desc("score"), source, kind, F.coalesce("nearest_km", F.lit(0.0)), F.desc(F.coalesce("population", F.lit(0))), "id"))
    scored = scored.withColumn("_r", rank).withColumn("_top", F.max("score").over(w))
    cell = F.concat_ws(",", F.round("lat", 1).cast("string"), F.round("lon", 1).cast("string"))
    rivals = F.size(F.collect_set(F.when((F.col("source") != "osm") & (F.abs(F.col("score") - F.col("_top")) < 1e-9), cell)).over(w))
    best = scored.withColumn("_rivals", rivals).filter("_r = 1")
    alone = (F.col("source") == "geonames") & (F.col("n_entries") == 0)
    score = F.when(alone & (F.col("_rivals") > 1), F.least("score", F.lit(0.5))).when(alone & F.col("is_home") & (F.col("score") >= 0.7 - 1e-9), F.greatest("score", F.lit(0.8))).otherwise(F.col("score"))
    out = best.select("label", "id", "source", F.round(F.greatest(F.lit(0.0), F.least(score, F.lit(0.95))), 2).alias("confidence"))
    return out.withColumn("status", F.when(F.col("confidence") >= 0.8, "linked").when(F.col("confidence") >= 0.4, "review").otherwise("no_match"))


def hit_tier(category: Column, kind: Column) -> Column:
    """strong (a place or a natural feature), weak (a named thing that stands for one), or null for what never is a place."""
    among = lambda table: reduce(lambda x, y: x | y, [(category == c) & kind.isin(*types) for c, types in table.items()])
    strong = category.isin(*STRONG_CATEGORIES) | among(STRONG)
    return F.when(strong, "strong").when(category.isin(*WEAK_CATEGORIES) | among(WEAK), "weak")


def name_fits(label: Column, names: Column) -> Column:
    """One of the names is the label, or holds all its words and no more than two others."""
    own = F.array_except(place_tokens(label, fold_gazetteer), F.array(*map(F.lit, STOP_WORDS)))
    equal = F.exists(names, lambda x: fold_gazetteer(x) == fold_gazetteer(label))

    def holds(x: Column) -> Column:
        theirs = F.array_except(place_tokens(x, fold_gazetteer), F.array(*map(F.lit, STOP_WORDS)))
        return (F.size(F.array_except(own, theirs)) == 0) & (F.size(theirs) <= F.size(own) + 2)

    return equal | ((F.size(own) > 0) & F.exists(names, holds))


def place_candidates(labels: DataFrame, hits: DataFrame, gazetteer: DataFrame, anchors: DataFrame, home: tuple[str, str] = ("DE", "02"), agree_km: float = 10.0, near_km: float = 40.0) -> DataFrame:
    """What ``link_places`` chooses from: the search hits of each label that are places of its name, with the gazetteer's record near them, and the gazetteer's other records.

    labels: label, kind. hits: label, osm, category, type, name, name_de,
    display_name, lat, lon. gazetteer: as ``read_geonames`` gives it. anchors:
    label, entry, lat, lon of the other places of a label's entries. A record
    agrees with a hit if it has the label's name and lies within ``agree_km``; of
    several, that of the fitting class, the nearest, the most populous, the one of
    the least id. A label with neither hits nor records has no candidate.
    """
    keyed = labels.select("label", "kind", fold_gazetteer(F.col("label")).alias("key")).distinct()
    records = keyed.join(gazetteer, "key").select("label", F.col("id").alias("gid"), "name", "fclass", "fcode", "cc", "admin1", F.col("lat").alias("glat"), F.col("lon").alias("glon"), "population", "is_primary")
    is_home = F.coalesce((F.col("cc") == home[0]) & (F.col("admin1") == home[1]), F.lit(False))
    known = F.coalesce((F.col("fclass") == "P") & ((F.col("population") >= 5000) | F.col("is_primary")), F.lit(False))
    about = records.groupBy("label").agg(F.max(is_home).alias("has_home"), F.max(known).alias("settlement_elsewhere"))
    names = F.filter(F.array("name_de", "name", F.split_part(F.coalesce("display_name", F.lit("")), F.lit(","), F.lit(1))), lambda x: x.isNotNull() & (x != ""))
    found = hits.withColumn("tier", hit_tier(F.col("category"), F.col("type"))).filter(F.col("tier").isNotNull() & name_fits(F.col("label"), names))
    natural = F.coalesce(F.col("category").isin("natural", "waterway", "water", "leisure") | F.col("type").isin("protected_area", "nature_reserve", "reservoir", "forest", "wood"), F.lit(False))
    # whether a name fits is asked once a hit, and not at each step that reads the hits
    found = settled(found.select("label", "osm", "tier", "category", natural.alias("_natural"), "lat", "lon"))
    rank = lambda table: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), F.col("fclass")), F.lit(5))
    far = km(F.col("lat"), F.col("lon"), F.col("glat"), F.col("glon"))
    # hits and records of one label meet as the places they lie at: of the records of a class at one place only the first in order can be chosen
    spot = ["label", "_natural", "lat", "lon"]
    record = F.struct("gid", "fclass", "fcode", "cc", "glat", "glon", "population")
    sites = records.groupBy("label", "glat", "glon", "fclass").agg(F.min_by(record, F.struct((-F.col("population")).alias("p"), "gid")).alias("g"))
    agreed = found.select(*spot).distinct().join(sites, "label").withColumn("_km", far).filter(F.col("_km") <= agree_km)
    order = F.struct(F.when(F.col("_natural"), rank(NATURAL_FIRST)).otherwise(rank(SETTLED_FIRST)).alias("r"), "_km", (-F.col("g.population")).alias("p"), F.col("g.gid").alias("gid"))
    agreed = agreed.withColumn("_o", order).groupBy(*spot).agg(F.min_by(F.struct("g", "_o"), "_o").alias("_b"))
    agreed = found.join(agreed, spot).groupBy("label", "osm").agg(F.min_by("_b.g", "_b._o").alias("g"))
    both = found.join(agreed, ["label", "osm"], "left").select(
        "label", F.col("osm").alias("id"), F.when(F.col("g").isNotNull(), "osm+geonames").otherwise("osm").alias("source"), "tier", "category", F.lit(None).cast("string").alias("name_tier"),
        "g.fclass", "g.fcode", "g.cc", "g.population", F.coalesce("g.glat", "lat").alias("lat"), F.coalesce("g.glon", "lon").alias("lon"), F.lit(False).alias("is_home"), F.col("g.gid").alias("_used"),
    )
    a, b = fold_gazetteer(F.col("label")), fold_gazetteer(F.col("name"))
    contains = (b != "") & (a.contains(b) | b.contains(a))
    used = both.filter("_used is not null").select("label", F.col("_used").alias("gid")).distinct()
    alone = records.join(used, ["label", "gid"], "left_anti").select(
        "label", F.col("gid").cast("string").alias("id"), F.lit("geonames").alias("source"), F.lit(None).cast("string").alias("tier"), F.lit(None).cast("string").alias("category"),
        F.when(F.col("is_primary"), "primary").when(contains, "contains").otherwise("alternate").alias("name_tier"), "fclass", "fcode", "cc", "population", F.col("glat").alias("lat"), F.col("glon").alias("lon"), is_home.alias("is_home"),
    )
    every = both.drop("_used").unionByName(alone)
    support = context_support(every.select("label", "id", "lat", "lon"), anchors, near_km)
    every = every.join(support, ["label", "id"], "left").join(keyed.select("label", "kind"), "label").join(about, "label", "left")
    return every.withColumns({"n_entries": F.coalesce("n_entries", F.lit(0)), **{c: F.coalesce(c, F.lit(0.0)) for c in ("f_near", "f_mid")}, **{c: F.coalesce(c, F.lit(False)) for c in ("has_home", "settlement_elsewhere")}})


def acceptance(match_type: Column, confidence: Column, rank: Column, item_rank: Column, proposed: Column) -> Column:
    """linked, linked-broad or review for a taxon match: the type's least confidence and the rank's gate; broad ones only for names that were not proposed by a model."""
    fits = F.when(item_rank == "genus", F.upper(rank) == "GENUS").when(item_rank == "family", F.upper(rank) == "FAMILY").otherwise(F.upper(rank).isin("SPECIES", "SUBSPECIES"))
    exact = (match_type == "EXACT") & (confidence >= 90) & fits
    fuzzy = (match_type == "FUZZY") & (confidence >= 95) & fits
    return F.when(exact | fuzzy, "linked").when((match_type == "HIGHERRANK") & ~proposed, "linked-broad").otherwise("review")
