"""Degrees of separation in a who-appeared-with-whom graph.

The graph stays bipartite (``actor_id, movie``). Pairs of actors are never
built: a movie with n people would cost n² rows, a step over the movie costs n.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.cluster import broadcast_if_small, bucketed, checkpointed, small_side
from millrace.operators.ordering import with_ordinal

UNREACHABLE = 100
MAX_DISTANCE = 6
# Edges of one person or movie that lie in one bucket; more are spread over several.
SLOT_EDGES = 1_000_000


def actors_union(men: DataFrame, women: DataFrame) -> DataFrame:
    """Bag union."""
    return men.unionByName(women)


def actor_ids(people: DataFrame) -> DataFrame:
    """Dense ids from 0 in (name, gender) order; ``signed_id`` is −(id+1) for women."""
    numbered = with_ordinal(people, ["actor", "gender"], name="actor_id")
    return numbered.withColumn(
        "signed_id", F.when(F.col("gender") == "m", F.col("actor_id")).otherwise(-(F.col("actor_id") + 1))
    )


def movie_edges(actors_with_movies: DataFrame) -> DataFrame:
    """``actor_id, movies`` → distinct ``actor_id, movie``."""
    return actors_with_movies.select("actor_id", F.explode("movies").alias("movie")).distinct()


def graph_of_lists(people: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed lists ``actor, gender, movies`` → ``(actor_id, name, gender)`` and distinct edges, both written. Runs jobs.

    A person may have several rows; one name in both lists is two people.
    """
    people = checkpointed(people)
    ids = checkpointed(actor_ids(people.select("actor", "gender").distinct()))
    edges = movie_edges(people.join(broadcast_if_small(ids), ["actor", "gender"]).select("actor_id", "movies"))
    return ids.select("actor_id", F.col("actor").alias("name"), "gender"), checkpointed(edges)


def seed_lookup(actors: DataFrame, name: str) -> DataFrame:
    """The row of one named actor (smallest id if several); unknown names are an error."""
    found = actors.where(F.col("name") == name).agg(F.min("actor_id").alias("actor_id"))
    missing = F.raise_error(F.lit(f"no actor is named {name}")).cast("bigint")
    return found.select(F.lit(name).alias("name"), F.coalesce("actor_id", missing).alias("actor_id"))


def movie_casts(edges: DataFrame) -> DataFrame:
    """Cast size of each movie and the ordered pairs of different people in it."""
    cast = edges.distinct().groupBy("movie").agg(F.count("*").alias("cast_size"))
    return cast.withColumn("pairs", F.col("cast_size") * (F.col("cast_size") - 1))


def adjacency_sizes(edges: DataFrame) -> DataFrame:
    """Per actor: movies, and how many (movie, other person) entries the adjacency list has."""
    plain = edges.distinct()
    # Written first, so the join sees a plain table: a small one is broadcast, and a hot movie is split.
    casts = small_side(plain.groupBy("movie").agg(F.count("*").alias("cast_size")))
    return (
        plain.join(casts, "movie")
        .groupBy("actor_id")
        .agg(F.count("*").alias("movies"), F.sum(F.col("cast_size") - 1).alias("neighbour_entries"))
        .where("neighbour_entries > 0")
    )


def neighbour_counts(edges: DataFrame, exact_entries: int = 10_000, sketch_bits: int = 14) -> DataFrame:
    """Per actor: how many different people share a movie with them, ``(actor_id, neighbours, exact)``. Runs jobs.

    An actor whose adjacency list has at most ``exact_entries`` entries is counted exactly, by that many rows at most.
    For others the casts are mergeable distinct-count sketches, one a movie, united per actor, so no list is
    written out; their relative error is about 1.04 / 2^(``sketch_bits`` / 2). People without neighbours are left out.
    """
    plain = checkpointed(edges.select("actor_id", "movie").distinct())
    sizes = checkpointed(adjacency_sizes(plain).select("actor_id", (F.col("neighbour_entries") <= exact_entries).alias("exact")))
    few = plain.join(small_side(sizes.where("exact").select("actor_id")), "actor_id", "left_semi")
    # Only movies that such an actor is in; their casts are small, too.
    casts = plain.join(small_side(few.select("movie").distinct()), "movie", "left_semi").withColumnRenamed("actor_id", "other")
    met = few.join(checkpointed(casts), "movie").where("actor_id <> other")
    counted = met.select("actor_id", "other").distinct().groupBy("actor_id").agg(F.count("*").alias("neighbours"))
    many = sizes.where("NOT exact").select("actor_id")
    if not many.take(1):
        return counted.withColumn("exact", F.lit(True))
    wide = plain.join(small_side(many), "actor_id", "left_semi")
    held = plain.join(small_side(wide.select("movie").distinct()), "movie", "left_semi")
    sketches = small_side(held.groupBy("movie").agg(F.hll_sketch_agg("actor_id", sketch_bits).alias("people")))
    united = wide.join(sketches, "movie").groupBy("actor_id").agg(F.hll_union_agg("people").alias("people"))
    # The actor is in every cast.
    estimated = united.select("actor_id", F.greatest(F.hll_sketch_estimate("people") - 1, F.lit(1)).alias("neighbours"))
    return counted.withColumn("exact", F.lit(True)).union(estimated.withColumn("exact", F.lit(False)))


def coactors(edges: DataFrame, of: DataFrame) -> DataFrame:
    """Distinct people who share a movie with someone in ``of``, themselves excluded. Runs a job."""
    movies = small_side(edges.join(of.select("actor_id"), "actor_id", "left_semi").select("movie").distinct())
    near = edges.join(movies, "movie", "left_semi").select("actor_id").distinct()
    return near.join(of.select("actor_id"), "actor_id", "left_anti")


@dataclass
class Layout:
    """Edges of movies with two or more people, bucketed by ``(actor_id, _slot)`` and by ``(movie, _slot)``.

    A key with more than ``SLOT_EDGES`` edges has several slots and is listed in ``wide_actors`` or
    ``wide_movies`` with their number; the lists hold at most one row per ``SLOT_EDGES`` edges.
    """

    by_actor: DataFrame
    by_movie: DataFrame
    wide_actors: DataFrame
    wide_movies: DataFrame
    movies: int  # those with one person, too


def _slots(keys: DataFrame, wide: DataFrame) -> DataFrame:
    """One row per key and slot."""
    numbers = F.sequence(F.lit(0), F.coalesce("_slots", F.lit(1)) - 1)
    return keys.join(F.broadcast(wide), keys.columns, "left").select(*keys.columns, F.explode(numbers).alias("_slot"))


def _bucketed_by(edges: DataFrame, key: str, other: str, wide: DataFrame) -> DataFrame:
    slot = F.pmod(F.xxhash64(other), F.coalesce("_slots", F.lit(1))).cast("int")
    return bucketed(edges.join(F.broadcast(wide), key, "left").select(key, other, slot.alias("_slot")), key, "_slot")


def laid_out(edges: DataFrame, slot_edges: int = SLOT_EDGES) -> Layout:
    """Write the edges once by person and once by movie, for searches that move no edges. Runs jobs.

    ``edges`` holds distinct rows and is read twice. Movies with one person lead nowhere and are left out.
    """
    slots = F.ceil(F.col("n") / slot_edges).cast("int").alias("_slots")
    counted = Observation()
    sizes = edges.groupBy("movie").agg(F.count("*").alias("n")).observe(counted, F.count("movie").alias("movies"))
    casts = checkpointed(sizes.where("n > 1"))
    shared = checkpointed(edges.join(broadcast_if_small(casts.select("movie")), "movie", "left_semi"))
    sizes = shared.groupBy("actor_id").agg(F.count("*").alias("n"))
    wide_movies = checkpointed(casts.where(F.col("n") > slot_edges).select("movie", slots))
    wide_actors = checkpointed(sizes.where(F.col("n") > slot_edges).select("actor_id", slots))
    return Layout(
        _bucketed_by(shared, "actor_id", "movie", wide_actors),
        _bucketed_by(shared, "movie", "actor_id", wide_movies),
        wide_actors,
        wide_movies,
        counted.get["movies"],
    )


def connected_actors(layout: Layout) -> DataFrame:
    """People with at least one co-actor, without a shuffle of edges."""
    return layout.by_actor.groupBy("actor_id", "_slot").agg(F.lit(1)).select("actor_id").distinct()


def step(layout: Layout, frontier: DataFrame) -> DataFrame:
    """Distinct people in the movies of ``frontier`` (``actor_id, _slot``), who are part of it themselves."""
    own = layout.by_actor.join(broadcast_if_small(frontier), ["actor_id", "_slot"], "left_semi").select("movie").distinct()
    movies = _slots(own, layout.wide_movies)
    return layout.by_movie.join(movies, ["movie", "_slot"], "left_semi").select("actor_id").distinct()


def search(layout: Layout, start: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Breadth-first ``actor_id, distance`` up to ``max_distance`` over edges that stay where they lie.

    Each round steps from the frontier to its movies and on to their people; who is new is told by the last two
    frontiers alone, since neighbours are at most one round apart. The people of a round are written, which keeps plans
    short and lets a lost executor cost one round. An empty frontier ends the search. Runs jobs.
    """
    frontier = checkpointed(_slots(start.select("actor_id").distinct(), layout.wide_actors))
    known = frontier
    once = F.col("_slot") == 0
    seen = frontier.where(once).select("actor_id", F.lit(0).alias("distance"))
    for distance in range(1, max_distance + 1):
        near = step(layout, frontier).join(known.where(once).select("actor_id"), "actor_id", "left_anti")
        last, frontier = frontier, checkpointed(_slots(near, layout.wide_actors))
        if frontier.isEmpty():
            break
        known = last.unionAll(frontier)
        seen = seen.unionAll(frontier.where(once).select("actor_id", F.lit(distance).alias("distance")))
    return seen


def reached(edges: DataFrame, seed: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Distance of everyone the search from ``seed`` arrives at; a seed without edges gives no rows.

    ``edges`` holds distinct rows; pass a table rather than a query. Runs jobs.
    """
    start = edges.join(seed.select("actor_id"), "actor_id", "left_semi")
    return search(laid_out(edges), start, max_distance)


def separation(edges: DataFrame, seed: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Distance of everyone who has a co-actor; 100 where the search did not arrive.

    ``edges`` as for ``reached``.
    """
    return separation_in(laid_out(edges), seed, max_distance)


def separation_in(layout: Layout, seed: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``separation`` over edges that are laid out already."""
    found = search(layout, seed, max_distance)
    return (
        connected_actors(layout)
        .join(found, "actor_id", "left")
        .select("actor_id", F.coalesce("distance", F.lit(UNREACHABLE)).alias("distance"))
    )


def _count_gender(gender: str) -> Column:
    return F.count_if(F.col("gender") == gender)


def separation_counts(distances: DataFrame, actors: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Men and women at each distance from 1 on, with running totals."""
    spark = distances.sparkSession
    per_distance = (
        distances.where(F.col("distance").between(1, max_distance))
        .join(actors.select("actor_id", "gender"), "actor_id")
        .groupBy("distance")
        .agg(_count_gender("m").alias("actors"), _count_gender("f").alias("actresses"))
    )
    all_steps = spark.range(1, max_distance + 1).select(F.col("id").cast("int").alias("distance"))
    # At most max_distance rows from here on.
    filled = all_steps.join(F.broadcast(per_distance), "distance", "left").fillna(0, ["actors", "actresses"])
    running = F.sum(F.col("actors") + F.col("actresses")).over(W.orderBy("distance"))
    return filled.select(
        "distance", "actors", "actresses", (F.col("actors") + F.col("actresses")).alias("total"), running.alias("running_total")
    )


def separation_names(distances: DataFrame, actors: DataFrame, at: int = MAX_DISTANCE) -> DataFrame:
    """Names at one distance, numbered from 1 in name order within each gender."""
    names = (
        distances.where(F.col("distance") == at)
        .join(actors, "actor_id")
        .select("gender", F.col("name"), "actor_id")
    )
    numbered = with_ordinal(names, ["gender", "name", "actor_id"], name="number", within=["gender"])
    return numbered.select("gender", (F.col("number") + 1).alias("number"), "name")


def separation_report(
    distances: DataFrame,
    actors: DataFrame,
    edges: DataFrame,
    max_distance: int = MAX_DISTANCE,
    movies: int | None = None,
) -> DataFrame:
    """The text report as ``section, line_no, line``; sort by the first two to print it.

    ``movies`` is the number of different movies where it is known, as from ``laid_out``.
    """
    distances = checkpointed(distances)
    totals = actors.agg(
        _count_gender("m").alias("men"), _count_gender("f").alias("women"), F.count("*").alias("people")
    )
    # Single-row results, hence literals below.
    men, women, people = totals.first()
    one = distances.sparkSession.range(1)
    if movies is None:
        films_seen = edges.agg(F.count_distinct("movie").alias("movies"))
    else:
        films_seen = one.select(F.lit(movies).alias("movies"))
    steps = checkpointed(separation_counts(distances, actors, max_distance))

    # The sentences of the report.
    def text(section: int, line_no: int, line: Column) -> list[Column]:
        return [F.lit(section).alias("section"), F.lit(line_no).cast("bigint").alias("line_no"), line.alias("line")]

    def percent(n: str, whole: int) -> Column:
        return F.try_divide(F.col(n) * 100.0, F.lit(whole))

    def ratio(n: Column, whole: int) -> Column:
        return F.try_divide(n.cast("float"), F.lit(whole).cast("float")).cast("float").cast("string")

    def summary(line_no: int, label: str, n: Column, whole: int) -> DataFrame:
        start = F.lit(f"Total number of {label} from distance 1 to {max_distance} = ")
        return sums.select(*text(3, line_no, F.concat(start, n.cast("string"), F.lit(", ratio = "), ratio(n, whole))))

    def heading(section: int, label: str) -> DataFrame:
        return one.select(*text(section, 0, F.lit(f"List of {label} at distance {max_distance}:")))

    everyone = F.lit(
        f"Total number of actors = {people}, out of which {men} ({men * 100 // max(people, 1)}%) are males "
        f"while {women} ({women * 100 // max(people, 1)}%) are females."
    )
    films = F.format_string("Total number of movies = %d", "movies")
    at_distance = steps.select(
        F.lit(2).alias("section"),
        F.col("distance").cast("bigint").alias("line_no"),
        F.format_string(
            "There are %d (%.1f%%) actors and %d (%.1f%%) actresses at distance %d",
            "actors",
            percent("actors", men),
            "actresses",
            percent("actresses", women),
            "distance",
        ).alias("line"),
    )
    sums = steps.agg(F.sum("actors").alias("a"), F.sum("actresses").alias("b"))
    a, b = F.col("a"), F.col("b")
    names = separation_names(distances, actors, max_distance).select(
        F.when(F.col("gender") == "m", 4).otherwise(5).alias("section"),
        F.col("number").alias("line_no"),
        F.concat(F.col("number").cast("string"), F.lit(". "), F.col("name")).alias("line"),
    )
    parts = [
        one.select(*text(1, 1, everyone)),
        films_seen.select(*text(1, 2, films)),
        at_distance,
        summary(1, "actors", a + b, people),
        summary(2, "male actors", a, men),
        summary(3, "female actors (actresses)", b, women),
        heading(4, "male actors"),
        heading(5, "female actors (actresses)"),
        names,
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
