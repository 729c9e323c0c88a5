"""Entity resolution: layers of matches with shrinking pools, decisions and bands, clusters under constraints, and their quality."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.names import birth_match, birth_token, folded_name, sorted_tokens, subsequence_ratio
from touchline.operators.graph import connected_components
from touchline.operators.similarity import Stage, _first, name_index, nearest_names

#: Parts of position names and the group they stand for, the first that occurs counts (fixed values).
POSITION_GROUPS = [("gk", "Goalkeeper"), ("goalkeeper", "Goalkeeper"), ("df", "Defender"), ("defender", "Defender"), ("mf", "Midfielder"), ("midfielder", "Midfielder"), ("fw", "Forward"), ("forward", "Forward"), ("back", "Defender"), ("midfield", "Midfielder"), ("wing", "Forward"), ("striker", "Forward")]
#: Weights of name, birth date and position, the score of other position groups, and the bonus of an equal number (fixed values).
NAME_WEIGHT, BIRTH_WEIGHT, POSITION_WEIGHT, OTHER_GROUP, NUMBER_BONUS = 0.60, 0.25, 0.15, 25.0, 3.0


@dataclass(frozen=True)
class Layer:
    """What a layer compares: matches score ``threshold`` or more, candidates' names have a cosine of ``floor`` or more."""

    threshold: float
    floor: float
    birth: bool = True
    number: bool = False
    team: bool = False


#: From strict to relaxed (fixed values).
LAYERS = (Layer(90.0, 0.4, number=True, team=True), Layer(80.0, 0.3), Layer(75.0, 0.25, birth=False))
#: Candidates of a row in each direction.
TOP = 5


def position_group(position: Column) -> Column:
    text, out = F.lower(position), F
    for part, group in POSITION_GROUPS:
        out = out.when(text.contains(part), group)
    return out


def prepared(rows: DataFrame) -> DataFrame:
    """``id, full, short, sought, birth, place, number, team`` of rows with ``id, name`` and, where they have them, ``short_name,
    birth_date, position, number, team``; ``sought`` is the text whose n-grams are compared."""
    of = lambda c: F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")
    out = rows.select("id", folded_name(F.col("name")).alias("full"), folded_name(of("short_name")).alias("short"), F.nullif(of("birth_date"), F.lit("")).alias("birth"), position_group(of("position")).alias("place"), F.nullif(of("number"), F.lit("")).alias("number"), F.nullif(folded_name(of("team")), F.lit("")).alias("team"))
    return out.withColumn("sought", F.trim(F.concat_ws(" ", "full", "short", birth_token(F.col("birth"))))).withColumn("short", F.nullif("short", F.lit("")))


def _score(layer: Layer) -> Column:
    """Of a pair of prepared rows a and b: the weighted mean of what both have, and a bonus for an equal number."""
    ratio = lambda x, y: subsequence_ratio(sorted_tokens(F.col(f"a.{x}")), sorted_tokens(F.col(f"b.{y}")))
    either = lambda x, y, *ok: F.when(sum((F.col(c).isNull().cast("int") for c in ok), F.lit(0)) == 0, ratio(x, y))
    name = F.greatest(F.coalesce(ratio("full", "full"), F.lit(0.0)), either("short", "full", "a.short"), either("full", "short", "b.short"), either("short", "short", "a.short", "b.short"))
    parts = [(NAME_WEIGHT, name), (POSITION_WEIGHT, F.when(F.col("a.place") == F.col("b.place"), 100.0).when(F.col("a.place") != F.col("b.place"), OTHER_GROUP))]
    if layer.birth:
        parts.append((BIRTH_WEIGHT, birth_match(F.col("a.birth"), F.col("b.birth"))))
    weight = sum((F.when(value.isNotNull(), w).otherwise(0.0) for w, value in parts), F.lit(0.0))
    score = sum((w * F.coalesce(value, F.lit(0.0)) for w, value in parts), F.lit(0.0)) / weight
    if layer.number:
        score = F.when(F.col("a.number") == F.col("b.number"), F.least(F.lit(100.0), score + NUMBER_BONUS)).otherwise(score)
    return F.round(score, 6)


def _layer(a: DataFrame, b: DataFrame, layer: Layer, stage: Stage) -> DataFrame:
    """``id_a, id_b, score``: pairs that are each other's best candidate and reach the layer's threshold."""
    if layer.team:
        a, b = stage(a.join(b.select("team").distinct(), "team", "left_semi"), "layer-a"), stage(b.join(a.select("team").distinct(), "team", "left_semi"), "layer-b")
    index = name_index(a, b, "id", "sought", 3, stage)
    whole = lambda rows, s: rows.select(F.col("id").alias(f"id_{s}"), F.struct("full", "short", "birth", "place", "number").alias(s))

    def best(of: str, by: DataFrame, to: DataFrame, only: DataFrame | None = None) -> DataFrame:
        """The best of the TOP candidates of each row on one side, copies of a name by their ids."""
        other = "b" if of == "a" else "a"
        ids = stage(_first(to.select(F.col("sought").alias("name"), "id"), ["name"], [F.col("id")], TOP).drop("rank"), "name-ids")
        near = nearest_names(index, ids, of, layer.floor, TOP, only)
        pairs = by.select(F.col("sought").alias("name"), F.col("id").alias(f"id_{of}")).join(near.select("name", F.col("id").alias(f"id_{other}")), "name").select("id_a", "id_b")
        scored = pairs.join(whole(by, of), f"id_{of}").join(whole(to, other), f"id_{other}").select("id_a", "id_b", _score(layer).alias("score"))
        return _first(scored, [f"id_{of}"], [F.col("score").desc(), F.col(f"id_{other}")], 1).drop("rank").where(F.col("score") >= layer.threshold)

    # From the smaller side to the larger one; then only the rows chosen there are to choose in their turn.
    (of, by), (other, to) = sorted((("a", a), ("b", b)), key=lambda x: x[1].count())
    claims = stage(best(of, by, to), "claims")
    chosen = stage(to.join(claims.select(F.col(f"id_{other}").alias("id")), "id", "left_semi"), "chosen")
    back = best(other, chosen, by, chosen.select(F.col("sought").alias("name")))
    return claims.join(back.select("id_a", "id_b"), ["id_a", "id_b"])


def resolve_layers(a: DataFrame, b: DataFrame, stage: Stage, layers: tuple[Layer, ...] = LAYERS) -> DataFrame:
    """``id_a, id_b, score, layer``: one-to-one matches of the rows of two sources (see ``prepared`` for their columns).

    Each layer takes of both sources the rows that no layer before it has matched; candidates have similar names, and a pair stays
    if each is the other's best candidate (ties: the smaller id). Rows without a name match nothing."""
    a, b, found = stage(prepared(a), "source-a"), stage(prepared(b), "source-b"), None
    for k, layer in enumerate(layers, 1):
        own = stage(_layer(a, b, layer, stage).withColumn("layer", F.lit(k)), "layer")
        found = own if found is None else found.unionByName(own)
        if k < len(layers):
            a = stage(a.join(own.select(F.col("id_a").alias("id")), "id", "left_anti"), "source-a")
            b = stage(b.join(own.select(F.col("id_b").alias("id")), "id", "left_anti"), "source-b")
    return found


#: A pair of records: its ends' sources and ids.
PAIR = ["source_a", "id_a", "source_b", "id_b"]


def _ordered_pair(rows: DataFrame) -> DataFrame:
    """The pair's smaller end first, so that a pair has one form."""
    a, b = F.struct(F.col("source_a").alias("s"), F.col("id_a").alias("i")), F.struct(F.col("source_b").alias("s"), F.col("id_b").alias("i"))
    low, high = F.least(a, b), F.greatest(a, b)
    return rows.withColumns({"source_a": low["s"], "id_a": low["i"], "source_b": high["s"], "id_b": high["i"]})


def banded(candidates: DataFrame, decisions: DataFrame, auto_min: float, reject_max: float, margin: float) -> DataFrame:
    """``PAIR, score, state, recommended``: what becomes of each candidate and of each pair decided by hand.

    ``candidates`` has ``PAIR, score, runner_up``, ``decisions`` ``PAIR, verdict`` (must or cannot) and ``decided_at``; the latest
    decision on a pair counts. States: ``hand`` (must link), ``blocked`` (cannot link), ``shadowed`` (one end is linked by hand to
    another record of the other end's source), else by score ``auto`` (``auto_min`` or more), ``reject`` (``reject_max`` or less) or
    ``queue``. A queued pair is recommended if it beats its runner-up (none: 0) by ``margin``, never on a tie."""
    if not 0 <= reject_max < auto_min or margin < 0:
        raise ValueError("bands need 0 <= reject_max < auto_min and no negative margin")
    latest = _first(_ordered_pair(decisions), PAIR, [F.col("decided_at").desc(), F.col("verdict")], 1).select(*PAIR, "verdict")
    best = _ordered_pair(candidates).groupBy(*PAIR).agg(F.max(F.struct("score", "runner_up")).alias("c"))
    pairs = best.join(latest, PAIR, "full_outer").select(*PAIR, F.coalesce("c.score", F.lit(100.0)).alias("score"), F.coalesce("c.runner_up", F.lit(0.0)).alias("rival"), "verdict", F.col("c").isNull().alias("only_decided"))
    must = latest.where("verdict = 'must'")
    ends = must.select(F.col("source_a").alias("s"), F.col("id_a").alias("i"), F.col("source_b").alias("to"), F.col("id_b").alias("partner")).unionByName(must.select(F.col("source_b").alias("s"), F.col("id_b").alias("i"), F.col("source_a").alias("to"), F.col("id_a").alias("partner")))
    ends = ends.groupBy("s", "i", "to").agg(F.min("partner").alias("low"), F.max("partner").alias("high"))
    for here, there in (("a", "b"), ("b", "a")):
        own = ends.select(F.col("s").alias(f"source_{here}"), F.col("i").alias(f"id_{here}"), F.col("to").alias(f"source_{there}"), F.col("low").alias(f"low_{here}"), F.col("high").alias(f"high_{here}"))
        pairs = pairs.join(own, [f"source_{here}", f"id_{here}", f"source_{there}"], "left")
    other = lambda here, there: (F.col(f"low_{here}") != F.col(f"id_{there}")) | (F.col(f"high_{here}") != F.col(f"id_{there}"))
    shadowed = F.coalesce(other("a", "b"), F.lit(False)) | F.coalesce(other("b", "a"), F.lit(False))
    state = F.when(F.col("verdict") == "must", "hand").when(F.col("verdict") == "cannot", "blocked").when(shadowed, "shadowed").when(F.col("score") >= auto_min, "auto").when(F.col("score") <= reject_max, "reject").otherwise("queue")
    recommended = (F.col("state") == "queue") & (F.col("score") - F.col("rival") >= margin) & (F.col("score") > F.col("rival"))
    out = pairs.withColumn("state", state).where("not only_decided or verdict = 'must'")
    return out.withColumn("recommended", recommended).select(*PAIR, "score", "state", "recommended")


def _placed(wishes: DataFrame, stage: Stage, most_rounds: int = 200) -> DataFrame:
    """``node, anchor``: each node at its best anchor, at most one node of a source at an anchor, nodes of higher priority first.

    ``wishes`` has ``node, source, anchor, score, best`` (the node's greatest score). In each round nodes ask at their best anchor that has
    not refused them; an anchor holds the first of a source and refuses the others. As all anchors rank nodes alike, that ends
    where placing the nodes one after the other would, whatever the order of the rounds."""
    wishes = stage(wishes, "wishes")
    for _ in range(most_rounds):
        asked = _first(wishes, ["node"], [F.col("score").desc(), F.col("anchor")], 1).drop("rank")
        held = stage(asked.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "source").orderBy(F.col("best").desc(), "node"))), "held")
        refused = held.where("rank > 1").select("node", "anchor")
        if refused.isEmpty():
            return held.select("node", "anchor")
        wishes = stage(wishes.join(refused, ["node", "anchor"], "left_anti"), "wishes")
    raise RuntimeError(f"places did not settle in {most_rounds} rounds")


def constrained_clusters(records: DataFrame, links: DataFrame, ranks: list[str], stage: Stage) -> DataFrame:
    """``source, id, cluster_source, cluster_id``: clusters of linked records with at most one record of a source in each.

    ``records`` has ``source, id``; ``links`` has ``PAIR, score``. ``ranks`` lists the sources, the leading one first; a cluster goes by
    its record of the leading source. Connected records are one cluster if no source has two. Else the source with most
    records (ties: the leading one) gives the anchors; records join the anchor they link to best (ties: the smaller) among those without a
    record of their source, records with higher scores first; then the rest fill anchors that their source has left free, both in order,
    and what finds none stays alone. Null ends and links to unknown records are ignored."""
    rank = F.array_position(F.array(*map(F.lit, ranks)), F.col("source"))
    name = lambda s, i: F.concat(F.lpad(F.array_position(F.array(*map(F.lit, ranks)), F.col(s)).cast("string"), 4, "0"), F.lit(":"), F.col(i).cast("string"))
    nodes = stage(records.where("source is not null and id is not null").distinct().select("source", "id", rank.alias("place"), name("source", "id").alias("node")), "records")
    known = nodes.select("node")
    edges = links.where("source_a is not null and source_b is not null and id_a is not null and id_b is not null").select(name("source_a", "id_a").alias("a"), name("source_b", "id_b").alias("b"), "score")
    edges = stage(edges.join(known.withColumnRenamed("node", "a"), "a", "left_semi").join(known.withColumnRenamed("node", "b"), "b", "left_semi"), "links")
    parts = connected_components(edges, stage)
    nodes = stage(nodes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")), "components")
    sizes = nodes.groupBy("component", "source", "place").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("component").agg(F.max("n").alias("most"), F.max_by("source", F.struct("n", -F.col("place"))).alias("anchor_source")).where("most > 1").select("component", "anchor_source")
    split = stage(split, "split-components")
    mixed = stage(nodes.join(split, "component"), "split-nodes")
    anchors = mixed.where("source = anchor_source").select("component", F.col("node").alias("anchor"))
    others = mixed.where("source <> anchor_source").select("component", "source", "node")
    ways = edges.select(F.col("a").alias("node"), F.col("b").alias("anchor"), "score").unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("anchor"), "score"))
    wishes = ways.join(others.drop("component"), "node").join(anchors.select("anchor"), "anchor").groupBy("node", "source", "anchor").agg(F.max("score").alias("score"))
    wishes = stage(wishes.withColumn("best", F.max("score").over(Window.partitionBy("node"))), "wishes")
    placed = stage(_placed(wishes, stage), "placed")
    # What is left over fills the anchors that its source has left free, the k-th the k-th.
    best = wishes.groupBy("node").agg(F.max("best").alias("best"))
    rest = others.join(placed.select("node"), "node", "left_anti").join(best, "node", "left").withColumn("k", F.row_number().over(Window.partitionBy("component", "source").orderBy(F.coalesce("best", F.lit(0.0)).desc(), "node")))
    taken = placed.join(others, "node").select("anchor", "source")
    free = anchors.join(rest.select("component", "source").distinct(), "component").join(taken, ["anchor", "source"], "left_anti").withColumn("k", F.row_number().over(Window.partitionBy("component", "source").orderBy("anchor")))
    placed = placed.unionByName(rest.join(free, ["component", "source", "k"]).select("node", "anchor"))
    group = nodes.join(split, "component", "left").join(placed.select("node", "anchor"), "node", "left").withColumn("cluster", F.when(F.col("anchor_source").isNull(), F.col("component")).otherwise(F.coalesce("anchor", "node")))
    group = stage(group.select("source", "id", "node", "cluster"), "clusters")
    lead = group.groupBy("cluster").agg(F.min_by(F.struct("source", "id"), "node").alias("lead"))
    return group.join(lead, "cluster").select("source", "id", F.col("lead.source").alias("cluster_source"), F.col("lead.id").alias("cluster_id"))


def quality(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """One row ``precision, recall, auto_precision, labelled`` of linked pairs (state ``hand`` or ``auto``) over labelled ones.

    ``pairs`` comes from ``banded``; ``truth`` has ``PAIR`` and ``label`` (match or non_match). A share of nothing is null, not 1."""
    linked = pairs.where("state in ('hand', 'auto')").select(*PAIR, "state")
    seen = _ordered_pair(truth).join(linked, PAIR, "left").select((F.col("label") == "match").alias("match"), "state")
    count = lambda c: F.count_if(c).cast("double")
    hit, false = F.col("match") & F.col("state").isNotNull(), ~F.col("match") & F.col("state").isNotNull()
    auto = F.coalesce(F.col("state") == "auto", F.lit(False))
    share = lambda x, of: F.try_divide(count(x), count(of))
    return seen.agg(share(hit, hit | false).alias("precision"), share(hit, F.col("match")).alias("recall"), share(hit & auto, (hit | false) & auto).alias("auto_precision"), F.count(F.lit(1)).alias("labelled"))
