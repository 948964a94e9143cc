"""Content similarity: genre tokens -> hashed term frequencies -> IDF ->
TF-IDF -> all pairs with cosine above a threshold -> per-movie lists.

Plan (all DataFrame/SQL, no UDF, nothing collected):

* Term frequencies are computed inside each movie row (array functions), so
  no shuffle is needed to build a movie's vector.
* Movies with the same term-frequency vector have the same TF-IDF vector, so
  the work is done once per distinct vector ("class", keyed by an exact text
  form of its sorted ``(term, tf)`` list).  A group of identical copies,
  however large, becomes one class row; only the final expansion is per
  movie.
* Document frequencies come from the class table (sum of class sizes), one
  partial aggregation over the movies.
* Candidate class pairs come from an exact prefix filter: vectors are L2
  normalised, terms ordered rarest first, and only the shortest prefix whose
  remaining suffix has norm <= threshold is indexed.  A pair above threshold
  shares a prefix term of both (Cauchy-Schwarz), so nothing is lost.  Each
  candidate pair is met once, at its first shared prefix term, in a per-term
  grid-salted join of entries that carry two numbers: the term's weight and
  the norm of the rest.  They bound the pair's cosine, and only pairs whose
  bound reaches the threshold fetch the two vectors.
* What is stored for the real-time job stays factored by class
  (``operators.factored``).  Movie pairs are expanded on demand only, by
  chunks of members dealt out evenly (:meth:`ContentModel.pairs`), and
  per-movie lists as numbered chunks of bounded length
  (:meth:`ContentModel.lists`); with ``k`` they are cut exactly without
  expanding all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank import schemas
from reelrank.functions.columns import java_split, rounded, sorted_recs
from reelrank.operators.ranks import numbered
from reelrank.session import written

# Slack below the threshold for the prefix bound, so floating rounding in the
# suffix norms can only make prefixes longer (more candidates), never shorter.
PREFIX_SLACK = 1e-6

# Movies of one class expanded together: a chunk is this part of all movies, within the limits.  A pair of chunks carries
# the ids of both, so larger ones carry less for a movie pair, and none holds more than its part of the work.
CHUNK, LARGEST_CHUNK, CHUNKS = 64, 1024, 1024

# Entries in a row of the list table.
LIST_CHUNK = 256

# Grid step of the candidate join: a term shared by c classes is split into a
# ceil(c / SALT_ROWS)-square grid of cells, so its quadratic pair work spreads
# over many tasks (about SALT_ROWS**2 pairs per cell) instead of one.
SALT_ROWS = 256


def _tokens(genres) -> F.Column:
    """Genre string -> lower-cased word tokens.

    The ``|`` list is split and re-joined with spaces, then lower-cased and
    split on single whitespace characters, both with JVM split semantics
    (trailing empty strings dropped, an empty string gives one empty token).
    """
    return _lower_tokens(_lower_words(genres))


def _lower_words(genres) -> F.Column:
    return F.lower(F.array_join(java_split(genres, r"\|"), " "))


def _lower_tokens(words) -> F.Column:
    return F.coalesce(java_split(words, r"\s"), F.array().cast("array<string>"))


def _term(token: F.Column, term_space: str, num_features: int) -> F.Column:
    if term_space == "hash":
        # SQL ``hash`` is Murmur3 (seed 42) over the UTF-8 bytes, the bucket
        # function of the hashed term frequency the reference relies on.
        return F.pmod(F.hash(token), F.lit(num_features))
    if term_space == "exact":
        return token
    raise ValueError(f"unknown term space {term_space!r}")


def genre_tokens(movies: DataFrame) -> DataFrame:
    """(mid, pos, token): tokenizer output, one row per token, pos 0-based.

    ``*_outer`` + a NULL filter instead of a plain explode: for a plain one
    Spark infers ``size(array) > 0`` and pushes it below the projections,
    which evaluates the whole array expression a second time.
    """
    return (movies.select("mid", F.posexplode_outer(_tokens(F.col("genres"))).alias("pos", "token"))
            .filter(F.col("pos").isNotNull()))


def term_counts(terms: F.Column) -> F.Column:
    """``array<struct<term, tf>>`` sorted by term: run lengths of the sorted
    array (O(n log n) inside the row, no shuffle).  NULL for no terms.

    Pass a column reference, not a computed expression: expressions used
    inside higher-order-function lambdas are evaluated again at every use.
    """
    s = F.array_sort(terms)
    return _runs(s)


def _runs(s: F.Column) -> F.Column:
    n = F.size(s)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                      lambda i: (i == 1) | (F.try_element_at(s, i) != F.try_element_at(s, F.greatest(i - 1, F.lit(1)))))
    runs = F.transform(starts, lambda st, j: F.struct(
        F.try_element_at(s, st).alias("term"),
        (F.coalesce(F.try_element_at(starts, j + 2), n + 1) - st).cast("double").alias("tf")))
    return F.when(n > 0, runs)


def _tf_vectors(movies: DataFrame, term_space: str, num_features: int) -> DataFrame:
    """(mid, sig): ``sig`` = term frequencies as ``array<struct<term, tf>>`` sorted by term.

    Staged projections: the lambdas below read the sorted terms as a column,
    so tokenising and sorting happen once per row.
    """
    term_type = "int" if term_space == "hash" else "string"
    empty = F.array().cast(f"array<struct<term:{term_type},tf:double>>")
    words = spread(movies.select("mid", "genres")).select("mid", _lower_words(F.col("genres")).alias("words"))
    sorted_terms = words.select("mid", F.array_sort(F.transform(
        _lower_tokens(F.col("words")), lambda t: _term(t, term_space, num_features))).alias("s"))
    return sorted_terms.select("mid", F.coalesce(_runs(F.col("s")), empty).alias("sig"))


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt out evenly: a movie table is small in bytes, so a scan gives it to a task or two, and the work on
    each row is not."""
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _exploded(sig: DataFrame, *cols: str) -> DataFrame:
    """``cols``, term and tf of each entry of ``sig``.

    ``explode_outer`` + a NULL filter, as in :func:`genre_tokens`: the
    ``size(sig) > 0`` that Spark infers for a plain explode goes below the
    grouping by ``sig``, where the tokenizer stands in place of every use of
    its column, inside the lambdas too.
    """
    return (sig.select(*cols, F.explode_outer("sig").alias("e")).filter(F.col("e").isNotNull())
            .select(*cols, F.col("e.term").alias("term"), F.col("e.tf").alias("tf")))


def hashed_tf(movies: DataFrame, num_features: int = schemas.HASHING_FEATURES,
              term_space: str = "hash") -> DataFrame:
    """(mid, term, tf) for every term a movie has."""
    return _exploded(_tf_vectors(movies, term_space, num_features), "mid")


@dataclass
class ContentModel:
    """Intermediate tables of the similarity computation.

    ``members``: (mid, ckey); ``classes``: (ckey, n, sig), ``ckey`` being a number if classes are numbered, else
    the text of ``sig``; ``idf``: (term, df, idf);
    ``vectors``: (ckey, n, vec) with ``vec`` = normalised
    ``array<struct<term, u, df>>`` sorted by term (zero weights and
    zero-norm classes removed).  Cosine sums fold over term order, so a
    score does not depend on how rows were partitioned.
    """

    members: DataFrame
    classes: DataFrame
    idf: DataFrame
    vectors: DataFrame
    threshold: float
    term_space: str
    num_features: int | None  # width of the hashed terms; None in the exact term space
    keep: bool = True  # whether class tables are kept for several reads
    chunk: int = CHUNK  # movies of a class expanded together
    _class_pairs: DataFrame | None = None
    _prefix: DataFrame | None = None

    def unpersist(self) -> None:
        """Release the cached class-level tables."""
        for df in (self.classes, self.idf, self.vectors, self._prefix, self._class_pairs):
            if df is not None:
                df.unpersist()

    # ---------------------------------------------------------- candidates
    def _prefix_entries(self) -> DataFrame:
        if self._prefix is None:
            self._prefix = self._kept(self._compute_prefix_entries())
        return self._prefix

    def _kept(self, df: DataFrame) -> DataFrame:
        return df.persist() if self.keep else df

    def _compute_prefix_entries(self) -> DataFrame:
        """(ckey, term, before, u, rest): one row per prefix term of each class.

        Terms are ordered rarest first (ties by term) -- one global order, so
        the prefix argument holds for every pair.  ``before`` lists the
        class's prefix terms that precede ``term``, ``u`` is the term's weight
        and ``rest`` the norm of the vector after it.
        """
        bound = max(self.threshold - PREFIX_SLACK, 0.0)
        ordered = F.sort_array(F.transform("vec", lambda x: F.struct(x["df"], x["term"], x["u"])))
        norm = lambda n: F.sqrt(F.aggregate(F.slice("p", n, F.size("p")), F.lit(0.0),
                                            lambda acc, y: acc + y["u"] * y["u"]))
        suffix = F.transform("p", lambda x, i: F.struct(
            x["term"].alias("term"), x["u"].alias("u"), norm(i + 1).alias("with"), norm(i + 2).alias("rest")))
        return (self.vectors
                .select("ckey", ordered.alias("p"))
                .select("ckey", F.filter(suffix, lambda x: x["with"] > bound).alias("s"))
                .select("ckey", F.transform("s", lambda x: x["term"]).alias("prefix"), F.posexplode_outer("s").alias("pos", "s"))
                .filter(F.col("pos").isNotNull())  # see genre_tokens
                .select("ckey", "s.term", F.slice("prefix", 1, F.col("pos")).alias("before"), "s.u", "s.rest"))

    def _term_cells(self) -> DataFrame:
        """The prefix entries with their term's grid size ``s``."""
        e = self._prefix_entries()
        grid = (e.groupBy("term").agg(F.count(F.lit(1)).alias("c"))
                .select("term", F.ceil(F.col("c") / SALT_ROWS).cast("int").alias("s")))
        return e.join(grid, "term").withColumn("own", F.pmod(F.xxhash64("ckey"), F.col("s")).cast("int"))

    def _term_join(self, least: float | None = None) -> DataFrame:
        """Self-join of prefix entries on a shared term, grid-salted per term; with ``least`` only pairs whose cosine
        can be above it (``most``).

        Each pair of classes sharing prefix terms is met once, at its first
        shared prefix term.  A term held by ``c`` classes is split into an
        ``S x S`` grid, ``S = ceil(c / SALT_ROWS)``: the left side of the
        join picks its row ``hash(ckey) % S`` and is copied to every column,
        the right side picks its column and is copied to every row, so each
        class pair meets in exactly one cell and a cell holds at most about
        ``SALT_ROWS**2`` pairs however popular the term.  Both sides are
        hash-partitioned on the cell with an explicit count (AQE does not
        coalesce it): the work is quadratic in a term's classes while the
        input is small in bytes, and whichever side AQE broadcasts, the
        other stays spread over many cells.
        """
        spark = self.vectors.sparkSession
        parallelism = max(spark.sparkContext.defaultParallelism,
                          int(spark.conf.get("spark.sql.shuffle.partitions")))
        e = self._term_cells()
        every = F.explode(F.sequence(F.lit(0), F.col("s") - 1))
        left = (e.select("*", F.col("own").alias("gr"), every.alias("gc"))
                .repartition(parallelism, "term", "gr", "gc").alias("a"))
        right = (e.select("*", every.alias("gr"), F.col("own").alias("gc"))
                 .repartition(parallelism, "term", "gr", "gc").alias("b"))
        cond = ((F.col("a.term") == F.col("b.term")) & (F.col("a.gr") == F.col("b.gr"))
                & (F.col("a.gc") == F.col("b.gc")) & (F.col("a.ckey") < F.col("b.ckey")))
        if least is not None:
            cond = cond & (F.col("a.u") * F.col("b.u") + F.col("a.rest") * F.col("b.rest") > least)
        return (left.join(right, cond)
                .filter(~F.arrays_overlap(F.col("a.before"), F.col("b.before")))
                .select(F.col("a.ckey").alias("ca"), F.col("b.ckey").alias("cb")))

    def candidate_pairs(self) -> DataFrame:
        """(ca, cb) with ca < cb sharing a prefix term (exact prefix filter),
        each pair once."""
        return self._term_join()

    def surviving_pairs(self) -> DataFrame:
        """The candidates whose cosine can reach the threshold: most end before a vector is fetched.

        Where a pair meets, at its first shared prefix term, it shares no
        earlier term at all, so its cosine is the product of the two weights
        there plus what the rest of both vectors give: at most the product of
        their norms (Cauchy-Schwarz).  The term entries carry these numbers.
        """
        return self._term_join(self.threshold - PREFIX_SLACK)

    # ---------------------------------------------------------- class pairs
    def class_pairs(self) -> DataFrame:
        """(ca, cb, score) for every ordered class pair with cosine > threshold,
        including a class with itself when it holds two or more movies.
        Kept only after :meth:`keep_class_pairs`: the set is quadratic in
        the classes, and most uses read it once."""
        return self._compute_class_pairs() if self._class_pairs is None else self._class_pairs

    def keep_class_pairs(self) -> None:
        """Keep the class pairs for several reads, until :meth:`unpersist`."""
        if self._class_pairs is None:
            self._class_pairs = self._compute_class_pairs().persist()

    def _compute_class_pairs(self) -> DataFrame:
        # Survivors fetch the two vectors: one sparse, one by term (a dense array in hash mode).
        vec = self.vectors.select("ckey", F.transform("vec", lambda x: F.struct(x["term"], x["u"])).alias("vec"))
        look = vec.select("ckey", F.map_from_entries("vec").alias("look"))
        if self.num_features:  # hashed terms: a dense array is read by position
            slots = F.sequence(F.lit(0), F.lit(self.num_features - 1))
            look = look.select("ckey", F.transform(
                slots, lambda i: F.coalesce(F.try_element_at("look", i.cast("bigint")), F.lit(0.0))).alias("look"))
        weight = ((lambda t: F.element_at(F.col("look"), t + 1)) if self.num_features else
                  (lambda t: F.coalesce(F.try_element_at(F.col("look"), t), F.lit(0.0))))
        dot = F.aggregate(F.col("vec"), F.lit(0.0), lambda acc, x: acc + x["u"] * weight(x["term"]))
        scored = (self.surviving_pairs().join(vec.withColumnRenamed("ckey", "ca"), "ca")
                  .join(look.withColumnRenamed("ckey", "cb"), "cb").select("ca", "cb", dot.alias("score")))
        # Both directions from one pass.  The threshold filter comes after
        # the explode on purpose: a filter on ``score`` placed before it is
        # pushed into the join condition and the (interpreted) dot product
        # would be evaluated again there.
        both = (scored.select(F.explode(F.array(
                    F.struct(F.col("ca").alias("ca"), F.col("cb").alias("cb"), "score"),
                    F.struct(F.col("cb").alias("ca"), F.col("ca").alias("cb"), "score"))).alias("p"))
                .select("p.*")
                .filter(~F.isnan("score") & (F.col("score") > self.threshold)))
        return both.unionByName(self.self_pairs())

    def self_pairs(self) -> DataFrame:
        """(ca, cb, score) of each class of two or more movies with itself."""
        return (self.vectors.filter(F.col("n") >= 2)
                .select(F.col("ckey").alias("ca"), F.col("ckey").alias("cb"),
                        F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x["u"] * x["u"]).alias("score"))
                .filter(~F.isnan("score") & (F.col("score") > self.threshold)))

    # ---------------------------------------------------------- movie pairs
    def pairs(self, digits: int | None = None) -> DataFrame:
        """(mid, other_mid, score): every directed movie pair above threshold, its score rounded to ``digits`` if given
        (once for each pair of chunks).

        Members come in chunks of about ``chunk`` movies.  A class pair becomes
        a grid of chunk pairs, dealt out evenly over the tasks before they
        are expanded, so a class of a third of all movies gives every task
        the same share of its (quadratic) pairs: a chunk pair makes about
        ``chunk**2`` rows wherever it lands.
        """
        spark = self.vectors.sparkSession
        parallelism = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        chunks = self.chunks()
        count = self.classes.select("ckey", F.ceil(F.col("n") / self.chunk).cast("int").alias("parts"))
        score = F.col("score") if digits is None else rounded("score", digits).alias("score")
        left = count.select(F.col("ckey").alias("ca"), F.col("parts").alias("pa"))
        right = count.select(F.col("ckey").alias("cb"), F.col("parts").alias("pb"))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        grid = (self.class_pairs().join(left, "ca").join(right, "cb")
                .select("ca", "cb", score, "pb", every("pa").alias("i"))
                .select("ca", "cb", "score", "i", every("pb").alias("j")))
        mine = chunks.select(F.col("ckey").alias("ca"), F.col("chunk").alias("i"), F.col("mids").alias("own"))
        other = chunks.select(F.col("ckey").alias("cb"), F.col("chunk").alias("j"), F.col("mids").alias("others"))
        return (grid.join(mine, ["ca", "i"]).join(other, ["cb", "j"]).select("own", "others", "score")
                .repartition(parallelism)  # round robin: the same number of chunk pairs for every task
                .select(F.explode("own").alias("mid"), "others", "score")
                .select("mid", F.explode("others").alias("other_mid"), "score")
                .filter(F.col("mid") != F.col("other_mid")))

    def chunks(self) -> DataFrame:
        """(ckey, chunk, parts, mids): the members of each class in ``parts`` lists of about ``chunk`` movies."""
        sized = (self.members.join(self.classes.select("ckey", F.ceil(F.col("n") / self.chunk).cast("int").alias("parts")), "ckey")
                 .withColumn("chunk", F.pmod(F.xxhash64("mid"), F.col("parts")).cast("int")))
        return sized.groupBy("ckey", "chunk", "parts").agg(F.collect_list("mid").alias("mids"))

    # ---------------------------------------------------------- lists
    def class_entries(self) -> DataFrame:
        """(ca, place, mid, score): the list that the movies of a class share, the class's own movies included.

        ``place`` (0-based; score desc, mid asc) is the number of movies in
        better classes plus the place among the movies of equal score: the
        movie's position in its class, or, where several classes tie, its
        place among all their movies, numbered in runs of ids.  Members come
        in chunks, so neither a list nor a class is ever in one group.
        """
        sizes = self.classes.select(F.col("ckey").alias("cb"), "n")
        tie = Window.partitionBy("ca", "score")
        placed = (self.class_pairs().join(sizes, "cb")
                  .withColumn("upto", F.sum("n").over(Window.partitionBy("ca").orderBy(F.desc("score"))))
                  .withColumn("tied", F.count(F.lit(1)).over(tie))
                  .withColumn("before", F.col("upto") - F.sum("n").over(tie)))
        placed = written(placed, "class_places")  # read twice
        chunk = F.floor(F.col("pos") / CHUNK).cast("int")
        chunks = (numbered(self.members, ["ckey"], "mid").groupBy(F.col("ckey").alias("cb"), chunk.alias("j"))
                  .agg(F.sort_array(F.collect_list("mid")).alias("mids")))
        parts = F.sequence(F.lit(0), (F.ceil(F.col("n") / CHUNK) - 1).cast("int"))
        members = (placed.select("ca", "cb", "score", "before", "tied", F.explode(parts).alias("j")).join(chunks, ["cb", "j"])
                   .select("ca", "score", "before", "tied", "j", F.posexplode("mids").alias("i", "mid")))
        alone = members.where("tied = 1").select(
            "ca", (F.col("before") + F.col("j") * CHUNK + F.col("i")).alias("place"), "mid", "score")
        several = (numbered(members.where("tied > 1").select("ca", "score", "before", "mid"), ["ca", "score"], "mid")
                   .select("ca", (F.col("before") + F.col("pos")).alias("place"), "mid", "score"))
        return alone.unionByName(several)

    def lists(self, size: int = LIST_CHUNK, digits: int | None = None) -> DataFrame:
        """(mid, chunk_no, first, recs): every similar movie of each movie in numbered chunks of at most ``size``, in the
        order of the whole scores, which are then rounded to ``digits`` if given.

        A movie's list is its class's without itself.  ``first`` is the rank
        (1-based) of a chunk's first entry; the movie's own place, which is
        known from its score alone, moves the ranks behind it by one.  The
        entries are made once a class; only a chunk that holds the movie
        itself is filtered for it.
        """
        score = (lambda x: x) if digits is None else (lambda x: rounded(x, digits))
        chunked = (self.class_entries().groupBy("ca", F.floor(F.col("place") / size).cast("int").alias("chunk_no"))
                   .agg(F.sort_array(F.collect_list(F.struct("place", "mid", "score"))).alias("items"))
                   .select("ca", "chunk_no", F.col("items")[0].alias("lead"), F.transform("items", lambda x: x["mid"]).alias("mids"),
                           F.transform("items", lambda x: F.struct(x["mid"], score(x["score"]).alias("score"))).alias("recs"))
                   .withColumns({"lo": F.array_min("mids"), "hi": F.array_max("mids")}))
        own = self.self_pairs().select("ca", F.col("score").alias("own_score"))
        per_class = (self.classes.select(F.col("ckey").alias("ca"), F.ceil(F.col("n") / self.chunk).cast("int").alias("parts"))
                     .join(own, "ca", "left"))
        mine = self.chunks().select(F.col("ckey").alias("ca"), F.col("chunk").alias("i"), F.col("mids").alias("own"))
        shared = ["chunk_no", "lead", "mids", "recs", "lo", "hi", "own_score"]
        dealt = (chunked.join(per_class, "ca")
                 .select("ca", *shared, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"))
                 .join(mine, ["ca", "i"])
                 .select(*shared, F.explode("own").alias("mid")))
        lead = F.col("lead")
        passed = (F.col("own_score") > lead["score"]) | ((F.col("own_score") == lead["score"]) & (F.col("mid") < lead["mid"]))
        has_own = F.col("mid").between(F.col("lo"), F.col("hi")) & F.array_contains("mids", F.col("mid"))
        others = F.when(has_own, F.filter("recs", lambda x: x["mid"] != F.col("mid"))).otherwise(F.col("recs"))
        return (dealt.where((F.col("lo") != F.col("mid")) | (F.col("hi") != F.col("mid")))
                .select("mid", "chunk_no", (lead["place"] + 1 - F.coalesce(passed, F.lit(False)).cast("long")).cast("int").alias("first"),
                        others.alias("recs")))

    def recs(self, k: int | None = None, digits: int | None = None) -> DataFrame:
        """The similar movies of each movie, sorted by score desc, mid asc.

        ``k=None`` keeps every similar movie, as the reference does, in
        numbered chunks (:meth:`lists`).  With ``k``: (mid, recs
        array<struct<mid, score>>), cut exactly: all movies of a class share
        one candidate list, so per class take the first ``k+1`` members of
        each similar class, keep the best ``k+1`` overall, and per movie drop
        itself and keep ``k``.
        """
        if k is None:
            return self.lists(digits=digits)
        first_members = (self.members
                         .withColumn("r", F.row_number().over(Window.partitionBy("ckey").orderBy("mid")))
                         .filter(F.col("r") <= k + 1)
                         .select(F.col("ckey").alias("cb"), F.col("mid").alias("other_mid")))
        per_class = (self.class_pairs().join(first_members, "cb")
                     .withColumn("r", F.row_number().over(
                         Window.partitionBy("ca").orderBy(F.desc("score"), F.asc("other_mid"))))
                     .filter(F.col("r") <= k + 1)
                     .select("ca", "other_mid", "score"))
        per_movie = (self.members.select("mid", F.col("ckey").alias("ca"))
                     .join(per_class, "ca")
                     .filter(F.col("mid") != F.col("other_mid"))
                     .withColumn("r", F.row_number().over(
                         Window.partitionBy("mid").orderBy(F.desc("score"), F.asc("other_mid"))))
                     .filter(F.col("r") <= k))
        return (per_movie.groupBy("mid")
                .agg(sorted_recs(F.collect_list(F.struct(F.col("other_mid").alias("mid"), "score")))
                     .alias("recs")))


def _class_key(sig, term_space: str):
    """Exact text key of a term-frequency vector.  Hash terms and counts are
    integers, so ``term:tf,...`` is unambiguous; string terms use JSON."""
    if term_space == "hash":
        return F.concat_ws(",", F.transform(sig, lambda x: F.concat_ws(
            ":", x["term"].cast("string"), x["tf"].cast("int").cast("string"))))
    return F.to_json(sig)


def content_model(movies: DataFrame, threshold: float = schemas.CONTENT_SIM_THRESHOLD,
                  num_features: int = schemas.HASHING_FEATURES, term_space: str = "hash", keep: bool = True,
                  store: bool = True, number: bool = True) -> ContentModel:
    """Build the class tables and TF-IDF vectors for :class:`ContentModel`.

    With ``keep`` the class-level tables (one row per distinct vector, a few
    rows per term) are persisted for several reads, until ``unpersist``; they
    are small next to the movie table however many copies a class holds.
    Without it nothing stays in memory (one-shot queries).  With ``store`` the
    movies' term frequencies are written to the scratch folder once, else
    every table below them tokenises the movies again; with ``number`` the classes
    are written too and numbered, so that what is quadratic in them carries
    numbers, not texts.
    """
    kept = (lambda df: df.persist()) if keep else (lambda df: df)
    per_movie = _tf_vectors(movies, term_space, num_features)
    if store:
        per_movie = written(per_movie, "movie_terms")
    members = per_movie.select("mid", _class_key(F.col("sig"), term_space).alias("ckey"))
    classes = (per_movie.groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
               .select(_class_key(F.col("sig"), term_space).alias("ckey"), "n", "sig"))
    chunk = CHUNK
    if store and number:
        classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "movie_classes")
        members = written(members.join(classes.select("ckey", "cid"), "ckey").select("mid", F.col("cid").alias("ckey")), "movie_members")
        chunk = max(CHUNK, min(LARGEST_CHUNK, (classes.agg(F.sum("n")).first()[0] or 0) // CHUNKS))
        classes = classes.select(F.col("cid").alias("ckey"), "n", "sig")
    classes = kept(classes)
    idf = kept(idf_from_classes(classes, movies))
    weighted = (_exploded(classes, "ckey", "n").join(idf, "term")
                .select("ckey", "n", "term", "df", (F.col("tf") * F.col("idf")).alias("w"))
                .filter(F.col("w") != 0))
    grouped = (weighted.groupBy("ckey", "n")
               .agg(F.sort_array(F.collect_list(F.struct("term", "w", "df"))).alias("vec")))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x["w"] * x["w"]))
    vectors = kept(grouped.withColumn("norm", norm).filter(F.col("norm") > 0)
                   .select("ckey", "n", F.transform("vec", lambda x: F.struct(
                       x["term"].alias("term"), (x["w"] / F.col("norm")).alias("u"), x["df"].alias("df")))
                       .alias("vec")))
    return ContentModel(members, classes, idf, vectors, threshold, term_space,
                        num_features if term_space == "hash" else None, keep, chunk)


def idf_from_classes(classes: DataFrame, movies: DataFrame) -> DataFrame:
    """(term, df, idf) with ``idf = ln((m + 1) / (df + 1))``, m = number of ``movies``, each of them in one class."""
    m = movies.select(F.count(F.lit(1))).scalar()  # no column is read, and the classes are made once
    return (_exploded(classes, "n").groupBy("term").agg(F.sum("n").alias("df"))
            .select("term", "df", F.ln((m + 1) / (F.col("df") + 1)).alias("idf")))


def idf_weights(movies: DataFrame, num_features: int = schemas.HASHING_FEATURES,
                term_space: str = "hash") -> DataFrame:
    return content_model(movies, num_features=num_features, term_space=term_space, keep=False, store=False).idf


def tfidf_weights(movies: DataFrame, num_features: int = schemas.HASHING_FEATURES,
                  term_space: str = "hash") -> DataFrame:
    """(mid, term, tf, weight) for every term of every movie (zero weights kept)."""
    idf = idf_weights(movies, num_features, term_space)
    return (hashed_tf(movies, num_features, term_space).join(idf.select("term", "idf"), "term")
            .select("mid", "term", "tf", (F.col("tf") * F.col("idf")).alias("weight")))


def content_sim_pairs(movies: DataFrame, threshold: float = schemas.CONTENT_SIM_THRESHOLD,
                      num_features: int = schemas.HASHING_FEATURES, term_space: str = "hash", digits: int | None = None) -> DataFrame:
    """(mid, other_mid, score): directed pairs of distinct movies with cosine > threshold; with ``digits`` rounded scores."""
    return content_model(movies, threshold, num_features, term_space, keep=False).pairs(digits)


def content_movie_recs(movies: DataFrame, threshold: float = schemas.CONTENT_SIM_THRESHOLD,
                       num_features: int = schemas.HASHING_FEATURES, term_space: str = "hash",
                       k: int | None = None, digits: int | None = None) -> DataFrame:
    """The similar movies of each movie, best first: all in chunks (mid, chunk_no, first, recs), with ``digits`` of rounded
    scores, or ``k`` in one list."""
    return content_model(movies, threshold, num_features, term_space, keep=False).recs(k, digits)


def similarity_entries(recs: DataFrame, mids: DataFrame | None = None) -> DataFrame:
    """(mid, other_mid, score, rank) from a stored list table, in chunks or one row per movie.

    With ``mids`` (a ``mid`` column) only those movies' lists are exploded:
    the semi join runs on list rows, before any entry is produced.
    """
    if mids is not None:
        recs = recs.join(mids.select("mid").distinct(), "mid", "left_semi")
    first = F.col("first") if "first" in recs.columns else F.lit(1)
    # outer: for a plain explode the lists would be computed again below it, for their size (see genre_tokens)
    return (recs.select("mid", first.alias("first"), F.posexplode_outer("recs").alias("pos", "r"))
            .filter(F.col("pos").isNotNull())
            .select("mid", F.col("r.mid").alias("other_mid"), F.col("r.score").alias("score"),
                    (F.col("pos") + F.col("first")).alias("rank")))


def tfidf_vectors(movies: DataFrame, num_features: int = schemas.HASHING_FEATURES) -> DataFrame:
    """(mid, features array<double>): dense hashed TF-IDF vector of each movie
    (the sparse -> dense step), built per class and expanded to movies."""
    model = content_model(movies, num_features=num_features, term_space="hash", keep=False, number=False)
    idf = model.idf.select("term", "idf")
    weights = (_exploded(model.classes, "ckey").join(idf, "term")
               .groupBy("ckey").agg(F.map_from_entries(F.collect_list(
                   F.struct("term", (F.col("tf") * F.col("idf")).alias("w")))).alias("m")))
    dense = F.transform(F.sequence(F.lit(0), F.lit(num_features - 1)),
                        lambda i: F.coalesce(F.try_element_at("m", i.cast("bigint")), F.lit(0.0)))
    return model.members.join(weights, "ckey", "left").select("mid", dense.alias("features"))
