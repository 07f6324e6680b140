"""PageRank, topic-sensitive PageRank and the graph tables they run on.

Ranks follow the convention that they sum to the number of nodes N: every node
starts at 1 and a pass computes ``(m / N + inflow) * (1 - alpha) + alpha * v``
where ``m`` is the mass of the nodes without out-links and ``v`` the teleport
weight (1 for plain PageRank).

Layout: links are hashed by source and sorted once; node state is hashed by id
with the same width. A pass then shuffles only the partially summed inflows.
Links of hub sources do not live in that layout: they stay spread out and meet
a broadcast of the few hub nodes.

What nodes without out-links hold is only needed as one sum until the last pass. So
all passes but the last move along the links between the other nodes only, and that
sum follows from what these send over their remaining links.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.operators.scale import HOT_ROWS, hot_entries, join_lookup
from tarnworks.session import checkpoint, pinned_layout, shuffle_width, stored

# Links of one task. The fewer the tasks, the more of what goes to one node is added up before it
# is shuffled.
TASK_LINKS = 4_000_000


def _or_zero(value: Column | str) -> Column:
    return F.coalesce(value, F.lit(0.0))


def whole_links(edges: DataFrame) -> DataFrame:
    return edges.filter("src is not null and dst is not null")


def _node_ends(edges: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """``id, degree, came``: links that leave and that reach a node."""

    def end(name: str, out: int, came: int) -> Column:
        return F.struct(
            F.col(name).alias("id"), F.lit(out).cast("long").alias("out"), F.lit(came).cast("long").alias("came")
        )

    ends = whole_links(edges).select(F.explode(F.array(end("src", 1, 0), end("dst", 0, 1))).alias("end")).select("end.*")
    if extra is not None:
        ends = ends.unionByName(extra.select(end("id", 0, 0).alias("end")).select("end.*"))
    return ends.filter("id is not null").groupBy("id").agg(F.sum("out").alias("degree"), F.sum("came").alias("came"))


def graph_nodes(edges: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """All ids seen as source or target (or in ``extra``) with their out-degree. Links with a
    null end, and null ids, count for nothing."""
    return _node_ends(edges, extra).select("id", "degree")


def dangling_nodes(edges: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Nodes without out-links; the degree count replaces an anti-join."""
    return graph_nodes(edges, extra).filter("degree = 0").select("id")


def node_counts(edges: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """One row: nodes, dangling nodes and links."""
    return graph_nodes(edges, extra).agg(
        F.count(F.lit(1)).alias("nodes"),
        F.count_if(F.col("degree") == 0).alias("dangling"),
        F.sum("degree").alias("links"),
    )


@dataclass
class LinkLayout:
    nodes: DataFrame  # id, degree; hashed by id
    links: DataFrame  # src, dst; hashed and sorted by src, without hub sources
    hub_links: DataFrame | None  # src, dst of hub sources, spread evenly
    hubs: DataFrame | None  # id of hub sources; at most BROADCAST_ROWS
    size: int
    width: int
    # The same of nodes with out-links and the links between them. Its nodes have ``closing``, the
    # number of their links to other nodes, too.
    inner: LinkLayout | None = None


def lay_out(
    edges: DataFrame, extra: DataFrame | None = None, hot_rows: int = HOT_ROWS, inner: bool = True
) -> LinkLayout:
    """Place nodes and links once, for any number of passes."""
    spark = edges.sparkSession
    edges = stored(whole_links(edges).select("src", "dst"))  # read for nodes and for links
    least = max(2 * spark.sparkContext.defaultParallelism, ceil(edges.count() / TASK_LINKS))
    width = min(shuffle_width(spark), least)
    with pinned_layout(spark):
        every = _node_ends(edges, extra)
        every = checkpoint(every.repartition(width, "id").sortWithinPartitions("id"))
    with pinned_layout(spark, width):
        nodes = every.select("id", "degree")
        size = nodes.count()
        hubs = hot_entries(nodes, "degree", hot_rows)
        pairs = edges.select("src", "dst")
        if inner:
            ends = every.select(F.col("id").alias("dst"), (F.col("degree") == 0).alias("closes"), "came")
            pairs = join_lookup(pairs, ends, ["dst"], "came", hot_rows).select("src", "dst", "closes")
        hub_links = None
        if hubs is not None:
            hubs = hubs.select("id")
            is_hub = F.broadcast(hubs.withColumnRenamed("id", "src"))
            pairs = checkpoint(pairs) if inner else pairs  # read twice
            hub_links = checkpoint(pairs.join(is_hub, "src").repartition(width, "src", "dst"))
            pairs = pairs.join(is_hub, "src", "left_anti")
        links = checkpoint(pairs.repartition(width, "src").sortWithinPartitions("src"))
        whole = LinkLayout(nodes, links, hub_links, hubs, size, width)
        if inner:
            whole.inner = _inner(whole)
    return whole


def _inner(whole: LinkLayout) -> LinkLayout:
    """Of a layout whose links have ``closes``: whether the target has no out-links."""

    def kept(links: DataFrame | None) -> DataFrame | None:
        return links and checkpoint(links.filter("not closes").select("src", "dst"))

    closing = whole.links.filter("closes").groupBy("src").agg(F.count(F.lit(1)).alias("closing"))
    nodes = whole.nodes.filter("degree > 0").join(closing.withColumnRenamed("src", "id"), "id", "left")
    if whole.hubs is not None:
        more = whole.hub_links.filter("closes").groupBy("src").agg(F.count(F.lit(1)).alias("more"))
        nodes = nodes.join(F.broadcast(more.withColumnRenamed("src", "id")), "id", "left")
        nodes = nodes.withColumn("closing", F.coalesce("closing", "more")).drop("more")
    nodes = checkpoint(nodes.withColumn("closing", F.coalesce("closing", F.lit(0))))
    return LinkLayout(nodes, kept(whole.links), kept(whole.hub_links), whole.hubs, whole.size, whole.width)


def _sent(layout: LinkLayout, state: DataFrame, payload: list[str]) -> DataFrame:
    """One row per link with the target and what the source sends along it."""
    senders = state.filter("degree > 0").select(F.col("id").alias("src"), *payload)
    sent = layout.links.join(senders, "src").select("dst", *payload)
    if layout.hubs is not None:
        few = senders.join(F.broadcast(layout.hubs.withColumnRenamed("id", "src")), "src")
        sent = sent.unionByName(
            layout.hub_links.join(F.broadcast(few), "src").select("dst", *payload)
        )
    return sent


def pagerank_pass(
    layout: LinkLayout, state: DataFrame, alpha: float, normalize: bool = False,
    lost: float | None = None, to: DataFrame | None = None,
) -> DataFrame:
    """One pass over ``state`` (id, degree, rank); other columns of it stay. ``lost`` is the rank of
    nodes without out-links, if ``state`` lacks these; ``to`` has the nodes to return, if others."""
    n = float(layout.size)
    shares = state.withColumn("share", F.col("rank") / F.col("degree"))
    inflow = (
        _sent(layout, shares, ["share"])
        .groupBy(F.col("dst").alias("id"))
        .agg(F.sum("share").alias("inflow"))
    )
    if lost is None:
        lost = (
            state.filter("degree = 0")
            .agg(_or_zero(F.sum("rank")).alias("lost"))
            .scalar()
        )
    rank = (lost / n + _or_zero("inflow")) * (1 - alpha) + alpha
    to = state if to is None else to
    return to.join(inflow, "id", "left").select(
        *[c for c in to.columns if c != "rank"], (rank / n if normalize else rank).alias("rank")
    )


def _start_inside(inner: LinkLayout, state: DataFrame, *columns: str) -> DataFrame:
    """``state`` at the nodes with out-links, with ``closing``."""
    begun = state.filter("degree > 0").select("id", *columns)
    return checkpoint(inner.nodes.join(begun, "id"))


def pagerank(
    edges: DataFrame,
    passes: int = 10,
    alpha: float = 0.15,
    *,
    extra_nodes: DataFrame | None = None,
    initial: DataFrame | None = None,
    normalize: bool = False,
    layout: LinkLayout | None = None,
) -> DataFrame:
    """Ranks after a fixed number of passes: ``id, rank`` (sums to N) and ``score``
    (= rank / N).

    ``initial`` (id, rank) resumes an earlier run. ``normalize`` divides by N within
    every pass. ``layout`` re-uses the placement of an earlier call on the same edges.
    """
    layout = layout or lay_out(edges, extra_nodes)
    inner, n = layout.inner, float(layout.size)
    spark = edges.sparkSession
    with pinned_layout(spark, layout.width):
        if initial is None:
            state = layout.nodes.withColumn("rank", F.lit(1.0))
        else:
            begun = initial.groupBy("id").agg(F.max("rank").alias("rank"))  # a doubled id counts once
            state = layout.nodes.join(begun, "id", "left").select(
                "id", "degree", F.coalesce("rank", F.lit(1.0)).alias("rank")
            )
            state = checkpoint(state)
        if inner is None or passes < 2:
            for _ in range(passes):
                state = checkpoint(pagerank_pass(layout, state, alpha, normalize))
        else:
            row = state.filter("degree = 0").agg(F.count(F.lit(1)).alias("n"), F.sum("rank").alias("lost")).first()
            closed, lost = row["n"], row["lost"] or 0.0
            closing = F.sum(F.col("rank") / F.col("degree") * F.col("closing"))
            state = _start_inside(inner, state, "rank")
            for _ in range(passes - 1):
                after = (closed * lost / n + (state.agg(closing).first()[0] or 0.0)) * (1 - alpha) + closed * alpha
                state = checkpoint(pagerank_pass(inner, state, alpha, normalize, lost))
                lost = after / n if normalize else after
            state = checkpoint(pagerank_pass(layout, state, alpha, normalize, lost, layout.nodes))
    return state.select("id", "rank", (F.col("rank") / n).alias("score"))


def damping_sweep(edges: DataFrame, alphas: Sequence[float], passes: int = 10) -> DataFrame:
    """PageRank at several teleport factors: alpha, id, rank, score.

    A pass is linear in the ranks, so with ``y[j]`` the ranks after j passes without teleport, those
    after k passes at factor a are ``sum(a * (1 - a)**j * y[j], j < k) + (1 - a)**k * y[k]``. Only one
    number moves along a link, whatever the number of factors; the sums stay at the nodes.
    """
    layout = lay_out(edges, inner=False)  # every pass adds to every node
    n = float(layout.size)

    def added(j: int) -> Column:
        weights = [(1 - float(a)) ** j * (float(a) if j < passes else 1.0) for a in alphas]
        terms = F.array(*[F.col("rank") * w for w in weights])
        return terms if j == 0 else F.zip_with("p", terms, lambda x, y: x + y)

    with pinned_layout(edges.sparkSession, layout.width):
        state = layout.nodes.withColumn("rank", F.lit(1.0))
        state = state.withColumn("p", added(0))
        for j in range(1, passes + 1):
            state = checkpoint(pagerank_pass(layout, state, 0.0).withColumn("p", added(j)))
    factors = F.array(*[F.lit(float(a)) for a in alphas])
    pairs = state.select("id", F.explode(F.arrays_zip(factors.alias("alpha"), F.col("p"))).alias("e"))
    rank = F.col("e")["p"]
    return pairs.select(F.col("e")["alpha"].alias("alpha"), "id", rank.alias("rank"), (rank / n).alias("score"))


def topic_sizes(topics: DataFrame) -> DataFrame:
    """Nodes per topic: ``topic, nodes``."""
    return topics.groupBy("topic").agg(F.count(F.lit(1)).alias("nodes"))


def topic_nodes(
    edges: DataFrame, index: DataFrame, topics: int, extra: DataFrame | None = None
) -> DataFrame:
    """Start state of a topic run from links and a page index (``id, name``).

    Nodes are all ends of links, ids with an adjacency line (``extra``) and pages that only the
    index names. The topic of a page comes from the byte length of its name; pages without an
    index row get topic 0. Every page starts with ``topics + 1`` ranks of 1.
    """
    named = index.groupBy("id").agg(F.max("name").alias("name"))
    seen = named.select("id") if extra is None else named.select("id").unionByName(extra.select("id"))
    return (
        graph_nodes(edges, seen)
        .join(named, "id", "left")
        .select(
            "id",
            "degree",
            F.coalesce(topic_from_name(F.col("name")), F.lit(0)).alias("topic"),
            F.array_repeat(F.lit(1.0), topics + 1).alias("p"),
        )
    )


def topic_from_name(name: Column) -> Column:
    """Topic 1-10 by byte length of the name."""
    return F.octet_length(name) % 10 + 1


def topic_pagerank(
    edges: DataFrame,
    topics: DataFrame,
    n_topics: int,
    passes: int = 10,
    alpha: float = 0.15,
    beta: float = 0.99,
    *,
    extra_nodes: DataFrame | None = None,
) -> DataFrame:
    """Topic-sensitive PageRank: ``id, topic, p`` with ``p[0]`` the plain rank and
    ``p[i]`` the rank biased to topic i.

    All ``n_topics + 1`` vectors move in one pass over the links. ``topics`` holds ``id, topic``
    and may hold ``p`` to start from, as ``topic_nodes`` gives it; an id with two rows keeps the
    larger topic. Nodes missing there get topic 0; ids that only ``extra_nodes`` has are nodes
    too. ``beta`` is the share of the teleport that goes to pages of the vector's own topic.
    """
    spark = edges.sparkSession
    layout = lay_out(edges, extra_nodes)
    ones = F.array_repeat(F.lit(1.0), n_topics + 1)
    begun = F.col("p") if "p" in topics.columns else F.lit(None).cast("array<double>")
    marked = topics.groupBy("id").agg(F.max(F.struct("topic", begun.alias("p"))).alias("of"))
    n = float(layout.size)
    slots = range(n_topics + 1)
    with pinned_layout(spark, layout.width):
        state = checkpoint(
            layout.nodes.join(marked, "id", "left").select(
                "id",
                "degree",
                F.coalesce(F.col("of.topic").cast("int"), F.lit(0)).alias("topic"),
                F.coalesce("of.p", ones).alias("p"),
            )
        )
        in_range = topic_sizes(state).filter(F.col("topic").between(1, n_topics))
        sizes = {r["topic"]: r["nodes"] for r in in_range.collect()}  # <= n_topics rows

        def teleport(i: int) -> Column:
            if i == 0:
                return F.lit(1.0)
            inside = sizes.get(i, 0)
            own = beta * n / inside if inside else 0.0
            other = (1 - beta) * n / (n - inside) if inside < n else 0.0
            return F.when(F.col("topic") == i, own).otherwise(other)

        sums = [F.sum(F.col("share")[i]).alias(f"in_{i}") for i in slots]

        def moved(over: LinkLayout, state: DataFrame, lost: list[float], to: DataFrame) -> DataFrame:
            shares = state.withColumn("share", F.transform("p", lambda x: x / F.col("degree")))
            inflow = _sent(over, shares, ["share"]).groupBy(F.col("dst").alias("id")).agg(*sums)
            rank = [(lost[i] / n + _or_zero(f"in_{i}")) * (1 - alpha) + alpha * teleport(i) for i in slots]
            kept = [c for c in to.columns if c != "p"]
            return checkpoint(to.join(inflow, "id", "left").select(*kept, F.array(*rank).alias("p")))

        # Of nodes without out-links: their number, their ranks and their teleport weights.
        row = state.filter("degree = 0").agg(
            F.count(F.lit(1)), *[F.sum(F.col("p")[i]) for i in slots], *[F.sum(teleport(i)) for i in slots]
        ).first()
        closed, lost, jumps = row[0], *([x or 0.0 for x in part] for part in (row[1 : n_topics + 2], row[n_topics + 2 :]))
        closing = [F.sum(F.col("p")[i] / F.col("degree") * F.col("closing")) for i in slots]
        every = state
        if passes:
            state = _start_inside(layout.inner, state, "topic", "p")
            for _ in range(passes - 1):
                sent = [x or 0.0 for x in state.agg(*closing).first()]
                after = [(closed * x / n + y) * (1 - alpha) + alpha * v for x, y, v in zip(lost, sent, jumps)]
                state, lost = moved(layout.inner, state, lost, state), after
            state = moved(layout, state, lost, every)
    return state.select("id", "topic", "p")


def rank_vectors(ranked: DataFrame) -> DataFrame:
    """Long form of topic ranks: one row per node and vector."""
    return ranked.select("id", "topic", F.posexplode("p").alias("vec", "rank"))
