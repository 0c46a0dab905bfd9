"""Search of names by an index of their grams, for any number of terms at once.

A gram is a run of one, two or three characters of an upper-cased name; the empty gram stands for any
name. The pieces of a term between its wildcards are cut into grams as long as they allow, so each term
has at least one. The names that hold the rarest gram of a term are found by equality, then held against its
other grams and the term by LIKE. No term needs all pairs of terms and names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.plans.reports import FIGURES, contains_term, of_source, riskiest_first
from repovitals.sources.store import LayerStore

#: Gram length; shorter grams serve terms with shorter pieces.
LONGEST = 3
#: Additions that are read side by side before they are folded into one.
FOLD_AFTER = 24


def _runs(text: Column, length: int) -> Column:
    """All runs of so many characters; none in a shorter text."""
    n = F.length(text)
    starts = F.when(n >= length, F.sequence(F.lit(1), n - length + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(text, i, F.lit(length)))


def name_grams(name: Column) -> Column:
    """The grams of a name, the empty one among them."""
    upper = F.upper(name)
    return F.array_distinct(F.concat(F.array(F.lit("")), *(_runs(upper, n) for n in range(1, LONGEST + 1))))


def term_grams(term: Column) -> Column:
    """The grams that a name must hold to match a term; the empty one where the term has wildcards only."""
    pieces = F.filter(F.split(F.upper(term), "[%_]"), lambda piece: piece != "")
    grams = F.transform(
        pieces,
        lambda piece: F.when(F.length(piece) < LONGEST, F.array(piece)).otherwise(_runs(piece, LONGEST)),
    )
    return F.when(F.size(pieces) == 0, F.array(F.lit(""))).otherwise(F.array_distinct(F.flatten(grams)))


class NameSearch:
    """An index of names in a folder of a store. It grows by additions, each of which counts once it is whole."""

    def __init__(self, store: LayerStore, name: str = "name_search", buckets: int = 256):
        self.store, self.spark, self.buckets = store, store.spark, buckets
        self.folder = f"{store.root}/{name}"

    def _bucket(self, gram: Column) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(self.buckets)).cast("int")

    def _version(self, part: str, number: int) -> str:
        return f"{self.folder}/{part}/version={number:020d}"

    def _versions(self) -> tuple[int, list[int]]:
        """Up to which addition all are folded, and the additions since."""
        folded = max(self.store.committed_versions(f"{self.folder}/folded"), default=0)
        return folded, [n for n in self.store.committed_versions(f"{self.folder}/added") if n > folded]

    def postings(self) -> DataFrame:
        """(bucket, gram, full_name), one row for each gram of each name."""
        schema = "gram string, full_name string, bucket int"
        folded, added = self._versions()
        paths = [self._version("folded", folded)] if folded else []
        paths += [self._version("added", n) for n in added]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        return reduce(DataFrame.union, [reader.parquet(path) for path in paths])

    def _write(self, postings: DataFrame, path: str) -> None:
        # Cut by ranges down to the name, as one gram may be in all names.
        keys = ("bucket", "gram", "full_name")
        ranges = postings.repartitionByRange(*keys).sortWithinPartitions(*keys)
        ranges.write.mode("overwrite").partitionBy("bucket").parquet(path)

    def add(self, names: DataFrame) -> None:
        """Add the values of full_name that are not held; NULL is none. A failed addition can be made again.

        One writer at a time. Names are never taken out: what is found is looked up in the product.
        """
        empty = F.lit("")
        held = self.postings().where((F.col("bucket") == self._bucket(empty)) & (F.col("gram") == empty))
        wanted = names.select("full_name").where(F.col("full_name").isNotNull()).distinct()
        new = wanted.join(held.select("full_name").hint("merge"), "full_name", "left_anti")
        # Names are small and make many postings: dealt to as many tasks as a shuffle has, not by their own size.
        # By a hash, as Spark leaves out a repartition by the column that the join has dealt by.
        new = new.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("full_name"))
        # There is always a gram; a plain explode would be guarded by a filter that cuts names, and terms, once
        # more, and each copy of them, as Spark pushes it below the distinct.
        postings = new.select(F.explode_outer(name_grams(F.col("full_name"))).alias("gram"), "full_name")
        folded, added = self._versions()
        number = max([folded, *added]) + 1
        self._write(postings.withColumn("bucket", self._bucket(F.col("gram"))), self._version("added", number))
        if len(added) + 1 >= FOLD_AFTER:
            self._write(self.postings(), self._version("folded", number))

    def candidates(self, terms: DataFrame) -> DataFrame:
        """(term, full_name): names that hold all grams of a term. Only files of these grams' buckets are read."""
        wanted = (
            terms.select("term")
            .where(F.col("term").isNotNull())
            .distinct()
            .withColumn("grams", term_grams(F.col("term")))
            .select("term", "grams", F.explode_outer("grams").alias("gram"))
            .withColumn("bucket", self._bucket(F.col("gram")))
        )
        buckets = [row.bucket for row in wanted.select("bucket").distinct().collect()]  # at most self.buckets
        postings = self.postings().where(F.col("bucket").isin(buckets))
        counts = postings.groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n"))
        fewest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "bucket", "gram", "grams"))
        rarest = wanted.join(counts, ["bucket", "gram"], "left").groupBy("term").agg(fewest.alias("rarest"))
        holds_all = F.forall("grams", lambda gram: F.contains(F.upper("full_name"), gram))
        return (
            postings.join(rarest.select("term", "rarest.bucket", "rarest.gram", "rarest.grams"), ["bucket", "gram"])
            .where(holds_all)
            .select("term", "full_name")
        )

    def search(
        self, product: DataFrame, terms: DataFrame, n: int = fx.SEARCH_LIMIT, source: str = fx.SOURCE
    ) -> DataFrame:
        """For each distinct value of `term` what `report_search` gives for it, with its place from 1.

        Names of the product that were not added are not found. A NULL term finds nothing.
        """
        place = F.row_number().over(Window.partitionBy("term").orderBy(*riskiest_first()))
        found = self.candidates(terms).where(contains_term(F.col("full_name"), F.col("term")))
        return (
            of_source(product, source)
            .select(*FIGURES, "last_updated")
            .join(found.hint("merge"), "full_name")
            .withColumn("place", place.cast("long"))
            .where(F.col("place") <= n)
            .select("term", "place", *FIGURES, "last_updated")
        )
