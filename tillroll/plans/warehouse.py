"""The star schema as partitioned Parquet tables, published all together or not at all.

Every load has a number and adds its own rows to each table, in the table's partition
``load_no=…``; nothing that lies there is rewritten. What was sold on a day and what is
known of a customer is kept as sums, sets, and least and greatest values per load,
which add up when they are read: a late row costs its own load only, and a load that
replaces another takes the other's share out by not reading its partition.

One row appended to ``published`` is the commit: the newest load's number, the numbers
of replaced loads, and the highest keys given out. A load that fails before that leaves
readers on what they had, and the next load clears its partition. One writer at a
time is assumed.
"""

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.people import age_group
from tillroll.operators.upsert import insert_absent
from tillroll.plans import reports
from tillroll.plans.dimensions import profile_of, profile_parts, seed_rows
from tillroll.plans.facts import PAIR, summary_of, summary_shoppers
from tillroll.schema import SEEDS, TABLES, conform

_PUBLISHED = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("load_id", T.StringType()),
        # The first load that counts; NULL once the tables are dropped.
        T.StructField("first", T.LongType()),
        # How many loads counted or were replaced since then, and which were replaced.
        T.StructField("loads", T.LongType()),
        T.StructField("hidden", T.ArrayType(T.LongType())),
        # Tables that are written as a whole: the load that wrote them last.
        T.StructField("snapshots", T.MapType(T.StringType(), T.LongType())),
        T.StructField("last_keys", T.MapType(T.StringType(), T.LongType())),
    ]
)

LOAD = "load_no"
# The column by which sales are split below their load.
MONTH = "sale_month"

# Kept beside the star schema, per load: the sums and sets that the summary is made of,
# and the files that were taken.
CELLS, SHOPPERS, LOADED_FILES = "summary_cells", "summary_shoppers", "loaded_files"


def _kept(*columns):
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


_INT, _LONG, _TEXT = T.IntegerType(), T.LongType(), T.StringType()
_MONEY = T.DecimalType(30, 2)
_PAIR = [(name, _INT) for name in PAIR]
KEPT = {
    CELLS: _kept(
        *_PAIR, ("product_key", _INT), ("payment_key", _INT), ("revenue", _MONEY), ("rows", _LONG)
    ),
    SHOPPERS: _kept(*_PAIR, ("customer_key", _LONG)),
    LOADED_FILES: _kept(("path", _TEXT), ("file_id", _TEXT)),
}
# Tables of a few rows that a load writes anew; the others gain a partition.
WHOLE = ["dim_time", *SEEDS]
BY_LOAD = [table for table in TABLES if table not in WHOLE]
BY_MONTH = ["fact_sales"]

# What stands in for an index on a key: sorted row groups on days and stores, which
# their least and greatest values tell apart, dictionaries on keys of few values, and
# Bloom filters on customers, who are anywhere.
_BLOOM = {
    "fact_sales": ["customer_key"],
    "dim_customer": ["customer_key", "customer_id"],
}
_SORTED = {
    "fact_sales": [MONTH, *PAIR],
    SHOPPERS: [*PAIR, "customer_key"],
    CELLS: PAIR,
    "fact_daily_summary": PAIR,
}


def month_of(day_key):
    return F.expr(f"{day_key} div 100").cast("int")


class Warehouse:
    """The seven tables below ``root``."""

    def __init__(self, spark, root):
        self.spark = spark
        self.root = root.rstrip("/")
        self._base, self._answers = (None, None), (None, {})
        self.refresh()

    # --- what is published --------------------------------------------------

    def refresh(self):
        """Look up what is published now; one row comes back, however many loads."""
        self.version, self.first, self.loads = 0, None, 0
        self.hidden, self.snapshots, self.last_keys = [], {}, {}
        newest = self._log().orderBy(F.desc("version")).limit(1).collect()
        for row in newest:
            self.version, self.first, self.loads = row.version, row.first, row.loads
            self.hidden = list(row.hidden)
            self.snapshots, self.last_keys = dict(row.snapshots), dict(row.last_keys)
        return self

    def _log(self):
        try:
            return self.spark.read.schema(_PUBLISHED).parquet(f"{self.root}/published")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _PUBLISHED)

    def publish(self, load_id=None, replaced=None, snapshots=(), last_keys=None, loads=0):
        """Commit the partitions of the next number as one new version."""
        self.version += 1
        self.loads += loads
        self.hidden = self.hidden + ([replaced] if replaced else [])
        self.snapshots = self.snapshots | {table: self.version for table in snapshots}
        self.last_keys = self.last_keys | (last_keys or {})
        state = (self.first, self.loads, self.hidden, self.snapshots, self.last_keys)
        (
            self.spark.createDataFrame([(self.version, load_id, *state)], _PUBLISHED)
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self.root}/published")
        )
        return self

    def number_of(self, load_id):
        """The number of a load that counts, or None."""
        if self.first is None:
            return None
        own = self._log().where((F.col("load_id") == load_id) & (F.col("version") >= self.first))
        last = own.agg(F.max("version")).first()[0]
        return None if last in self.hidden else last

    def has_load(self, load_id):
        return self.number_of(load_id) is not None

    def last_key(self, table):
        """Highest key given out in a table, replaced loads included."""
        return self.last_keys.get(table, 0)

    def folder(self, table, number=None):
        """A table's folder, or that of one of its partitions."""
        folder = f"{self.root}/data/{table}"
        return folder if number is None else f"{folder}/{LOAD}={number}"

    def paths(self, table):
        """Folders that make up a table."""
        if self.first is None:
            return []
        if table in WHOLE:
            number = self.snapshots.get(table)
            return [] if number is None else [self.folder(table, number)]
        return [self.folder(table)]

    def exists(self, table):
        """Whether a table is published and its folder is there."""
        if not self.paths(table):
            return False
        try:
            self.read(table)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def partitions(self, table, hidden=False, number=None):
        """A table's own rows per load, with the load's number and, if split, the month.

        Those of replaced loads come with ``hidden``, those of one load with its ``number``.
        """
        schema = TABLES.get(table) or KEPT[table]
        split = [T.StructField(LOAD, T.LongType())]
        if table in BY_MONTH:
            split.append(T.StructField(MONTH, T.IntegerType()))
        schema = T.StructType([*schema.fields, *split])
        if number is not None:
            folder = self.folder(table, number)
            reader = self.spark.read.schema(schema).option("basePath", self.folder(table))
            return reader.parquet(folder)
        rows = self.spark.read.schema(schema).parquet(self.folder(table))
        rows = rows.where(F.col(LOAD).between(self.first or 0, self.version))
        if self.hidden and not hidden:
            rows = rows.where(~F.col(LOAD).isin(self.hidden))
        return rows

    def read(self, table):
        """A table's rows, added up over the loads."""
        paths = self.paths(table)
        if not paths:
            raise LookupError(f"table {table} does not exist in {self.root}")
        names = TABLES[table].names
        if table in WHOLE:
            return self.spark.read.schema(TABLES[table]).parquet(*paths).select(names)
        if table == "dim_customer":
            return self._customers().select(names)
        if table == "fact_daily_summary":
            return self._summary().select(names)
        return self.partitions(table).select(names)

    def _alone(self):
        """Whether one load holds all there is, so that nothing has to be added up."""
        return self.loads <= 1 and not self.hidden

    def _customers(self):
        """Customers: profile of the newest load, least and greatest day, sum of sales.

        Customers whose loads were all replaced stay, without sales. The key that groups
        them is the one they are joined by, so a join that follows need not
        shuffle them again.
        """
        if self._alone():
            return self.partitions("dim_customer")
        rows = self.partitions("dim_customer", hidden=True)
        counts = ~F.col(LOAD).isin(self.hidden) if self.hidden else F.lit(True)
        # The profile as one number keeps the aggregation buffer all numbers.
        newest = F.when(counts, F.col(LOAD)).otherwise(F.col(LOAD) - self.version - 1)
        merged = rows.groupBy("customer_key").agg(
            F.max("customer_id").alias("customer_id"),
            F.max_by(profile_of(F.col("gender"), F.col("age")), newest).alias("_profile"),
            F.min(F.when(counts, F.col("first_purchase_date"))).alias("first_purchase_date"),
            F.max(F.when(counts, F.col("last_purchase_date"))).alias("last_purchase_date"),
            F.coalesce(F.sum(F.when(counts, F.col("total_transactions"))), F.lit(0)).alias(
                "total_transactions"
            ),
        )
        gender, age = profile_parts(F.col("_profile"))
        return merged.withColumns({"gender": gender, "age": age, "age_group": age_group(age)})

    def _summary(self):
        """The summary: rows of days and stores that one load alone has, as that load
        worked them out, and the others from their loads' sums and sets."""
        own = self.partitions("fact_daily_summary")
        if self._alone():
            return own
        shared = (
            own.groupBy(PAIR)
            .agg(F.count(F.lit(1)).alias("_loads"), F.min("summary_id").alias("summary_id"))
            .where("_loads > 1")
        )
        seeded = {table: self.read(table) for table in SEEDS}
        merged = summary_of(
            self.partitions(CELLS).join(shared, PAIR, "left_semi"),
            # The loads' sets united.
            summary_shoppers(self.partitions(SHOPPERS).join(shared, PAIR, "left_semi")),
            seeded,
        ).join(shared.drop("_loads"), PAIR)
        names = TABLES["fact_daily_summary"].names
        alone = own.join(shared, PAIR, "left_anti")
        return alone.select(names).unionByName(conform(merged, "fact_daily_summary"))

    def read_load(self, load_id):
        """The fact's rows of one load."""
        number = self.number_of(load_id)
        if number is None:
            return self.spark.createDataFrame([], TABLES["fact_sales"])
        return self.partitions("fact_sales", number=number).select(TABLES["fact_sales"].names)

    def sales_of_customer(self, customer_id):
        """One customer's sales; row groups without that customer are not read."""
        own = self.partitions("dim_customer", hidden=True).where(F.col("customer_id") == customer_id)
        key = own.agg(F.min("customer_key")).first()[0]
        return self.read("fact_sales").where(F.col("customer_key") == F.lit(key))

    def loaded_files(self, without_load=None):
        """``path`` and ``file_id`` of all files that current loads took."""
        try:
            files = self.partitions(LOADED_FILES)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], KEPT[LOADED_FILES])
        number = self.number_of(without_load) if without_load else None
        if number is not None:
            files = files.where(F.col(LOAD) != number)
        return files.select(KEPT[LOADED_FILES].names)

    def tables(self):
        return {table: self.read(table) for table in TABLES}

    # --- writing ------------------------------------------------------------

    def fresh(self, label):
        """A new path below the warehouse for data that is not published."""
        return f"{self.root}/data/{label}-{uuid.uuid4().hex}"

    def write(self, rows, table):
        """Write rows as a table's partition of the next load."""
        schema = TABLES.get(table) or KEPT[table]
        if table in TABLES:
            rows = conform(rows, table)
        else:
            rows = rows.select([rows[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
        if table in BY_MONTH:
            # Rows of a month meet in few tasks, and a large month is dealt to several.
            rows = rows.withColumn(MONTH, month_of("date_key")).hint("rebalance", MONTH)
        if table in _SORTED:
            rows = rows.sortWithinPartitions(*_SORTED[table])
        writer = rows.write.mode("overwrite")
        for column in _BLOOM.get(table, []):
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
        if table in _BLOOM:
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", True)
        if table in BY_MONTH:
            writer = writer.partitionBy(MONTH)
        writer.parquet(self.folder(table, self.version + 1))

    def clear(self):
        """Delete what a failed load has left behind under the next number."""
        for table in [*TABLES, *KEPT]:
            self.remove(self.folder(table, self.version + 1))

    def remove(self, path):
        """Delete a folder that nothing published names."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        settings = self.spark.sparkContext._jsc.hadoopConfiguration()
        place.getFileSystem(settings).delete(place, True)

    def reset(self, seed=True):
        """Start over with seven empty tables, seeded dimensions filled by default."""
        self.clear()

        def create(table):
            rows = self.spark.createDataFrame([], TABLES.get(table) or KEPT[table])
            if seed and table in SEEDS:
                rows = seed_rows(self.spark, table)
            self.write(rows.coalesce(1), table)

        # Tiny jobs, better run side by side.
        with ThreadPoolExecutor(len(TABLES)) as pool:
            list(pool.map(create, [*TABLES, CELLS, SHOPPERS]))
        self.first, self.loads, self.hidden = self.version + 1, 0, []
        keys = {table: len(SEEDS[table][2]) if seed and table in SEEDS else 0 for table in TABLES}
        return self.publish(snapshots=WHOLE, last_keys=keys)

    def seed(self):
        """Add the seeded dimensions' fixed values where they are absent."""
        self.clear()
        keys = {}
        for table, (key, natural, _) in SEEDS.items():
            existing, last = self.read(table), self.last_key(table)
            # At most as many rows as the fixed list has values.
            absent = insert_absent(existing, seed_rows(self.spark, table), [natural])
            values = [row[natural] for row in absent.orderBy(key).collect()]
            if values:
                added = self.spark.createDataFrame(
                    [(last + place, value) for place, value in enumerate(values, start=1)],
                    TABLES[table],
                )
                self.write(existing.unionByName(added).coalesce(1), table)
                keys[table] = last + len(values)
        return self.publish(snapshots=list(keys), last_keys=keys) if keys else self

    def drop(self):
        """Unpublish every table; the files stay for readers still at work."""
        if self.first is None:
            return self
        self.first, self.loads, self.hidden, self.snapshots = None, 0, [], {}
        return self.publish()

    def verify_columns(self):
        """``(table, number of columns, ok)`` for each of the seven tables.

        Names and types come from the files, not from the declaration.
        """
        found = []
        for table, declared in TABLES.items():
            columns = self._found_columns(table)
            expected = [(f.name, f.dataType.simpleString()) for f in declared.fields]
            found.append((table, len(columns), columns == expected))
        return found

    def _found_columns(self, table):
        """Names and types in a table's files, all loads together."""
        paths = self.paths(table)
        if not paths:
            return []
        try:
            found = self.spark.read.option("mergeSchema", True).parquet(*paths).dtypes
        except AnalysisException as problem:
            if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                return []
            # Folders without a file: a table without a row so far.
            return [(f.name, f.dataType.simpleString()) for f in TABLES[table].fields]
        names = TABLES[table].names
        found = [column for column in found if column[0] not in (LOAD, MONTH)]
        return sorted(found, key=lambda c: names.index(c[0]) if c[0] in names else len(names))

    # --- querying -----------------------------------------------------------

    def sales_base(self, keep=False):
        """The wide sales table; ``keep`` holds it in memory until the next version.

        Kept rows spill to disk and are recomputed from the written tables when
        an executor is lost. Without ``keep`` each use reads the columns it needs.
        """
        version, kept = self._base
        if version != self.version and kept is not None:
            kept.unpersist()
            kept = None
        if keep and kept is None:
            kept = reports.sales_base(self.tables()).persist(StorageLevel.MEMORY_AND_DISK)
        self._base = (self.version, kept)
        return kept if kept is not None else reports.sales_base(self.tables())

    def register_views(self):
        """Make the tables and ``sales_base`` available to SQL under their names.

        The session remembers whose views these are and of which version, and they
        are made anew only when that differs.
        """
        wanted = (self.root, self.version)
        if getattr(self.spark, "_tillroll_views", None) != wanted:
            for table, rows in self.tables().items():
                rows.createOrReplaceTempView(table)
            self.sales_base().createOrReplaceTempView("sales_base")
            self.spark._tillroll_views = wanted
        return self

    def query(self, sql, keep=False, **parameters):
        """Run SQL over the tables as they are published now; ``:name`` markers take
        parameters.

        Each call looks up the newest version, so an object held for long sees what other
        writers have loaded since. With ``keep`` the answer is held in memory and given
        again to the same question until the version changes.
        """
        self.refresh()
        version, answers = self._answers
        if version != self.version:
            for old in answers.values():
                old.unpersist()
            answers = {}
            self._answers = (self.version, answers)
        question = (sql, tuple(sorted(parameters.items())))
        if question in answers:
            return answers[question]
        self.register_views()
        answer = self.spark.sql(sql, args=parameters or None)
        if keep:
            answers[question] = answer.persist(StorageLevel.MEMORY_AND_DISK)
        return answer
