"""Several tables that change at once, and changes that rewrite only the files they touch.

New rows are written into fresh folders, where no reader looks. One record, a single file, then names
for every table the folders and files that make it up; it is there as a whole or not at all, and
readers resolve all tables through the latest final record. A load that fails on the way leaves the
old state in force. What it had recorded as a draft is taken up by the next run, or dropped.

Records hold a row per folder, and per file only where some files of a folder were replaced; they are
read by the driver, so a table should have parts in the tens of thousands rather than millions. One
writer at a time is meant: a second one that chose the same number fails.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemill.operators import changes as C
from tidemill.operators.quality import Rule
from tidemill.session import materialise

RECORD = "kind STRING, table STRING, part STRING, path STRING"
_PLACE, _MARK = "place", "mark"
_PART = "_part"
# Keys of a change are broadcast only if counted and at most so many.
FEW_KEYS = 100_000


class GateError(ValueError):
    """What a load wrote does not hold; its rows are in no record."""


def plain(path: str) -> str:
    """Listings and rows spell local paths in different ways."""
    return re.sub(r"^file:/+", "file:///", path if ":" in path else f"file://{path}")


@dataclass(frozen=True)
class Release:
    """The state that a record describes: by table and part, the folders and files with the rows, and by name how far
    the sources were taken in.

    Functions that change it return another one, which counts once it is saved."""

    spark: SparkSession
    root: str
    number: int = 0
    final: bool = True
    places: dict[str, dict[str, tuple[str, ...]]] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)

    # ---- reading

    def parts(self, table: str) -> list[str]:
        return sorted(self.places.get(table, {}))

    def paths(self, table: str, parts: Iterable | None = None) -> list[str]:
        own = self.places.get(table, {})
        return [p for part in (own if parts is None else {str(x) for x in parts}) for p in own.get(part, ())]

    def read(self, table: str, schema: StructType | str, parts: Iterable | None = None) -> DataFrame:
        """Rows of a table, or of some of its parts only."""
        paths = self.paths(table, parts)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def views(self, schemas: dict[str, str], prefix: str = "") -> None:
        """Session views of tables, all as of this record."""
        for table, schema in schemas.items():
            self.read(table, schema).createOrReplaceTempView(f"{prefix}{table}")

    # ---- writing

    def _with(self, table: str, changed: dict[str, tuple[str, ...]], keep: bool = True) -> Release:
        own = {**(self.places.get(table, {}) if keep else {}), **changed}
        return replace(self, final=False, places={**self.places, table: {k: v for k, v in own.items() if v}})

    def _written(self, table: str, df: DataFrame, part: str | None = None, gate: Gate | None = None) -> str:
        path = f"{self.root}/data/{table}/version={uuid.uuid4().hex}"
        watched = gate.watch(df) if gate else df
        if part:
            watched = watched.withColumn(_PART, F.col(part).cast("string")).hint("rebalance", _PART)
            watched.write.partitionBy(_PART).parquet(path)
        else:
            watched.write.parquet(path)
        if gate:
            gate.check(table)
        return path

    def _by_part(self, path: str) -> dict[str, tuple[str, ...]]:
        """The folders of a version that was written by part; values must do as folder names."""
        found = self.spark.read.schema(f"{_PART} STRING").parquet(path).distinct().collect()
        odd = [r[0] for r in found if r[0] is None or not re.fullmatch(r"[\w.-]+", r[0])]
        if odd:
            raise ValueError(f"parts must be words, numbers or dates, not {odd[:5]}")
        return {r[0]: (f"{path}/{_PART}={r[0]}",) for r in found}

    def replaced(self, table: str, df: DataFrame, part: str | None = None, parts: list | None = None, gate: Gate | None = None) -> Release:
        """All rows of a table replaced, or of the listed ``parts``; written once, also when ``df`` reads the table.

        ``part`` names the column that tells the part, by a word, a number or a date."""
        path = self._written(table, df, part, gate)
        if part is None:
            return self._with(table, {"": (path,)}, keep=False)
        return self._with(table, {str(p): () for p in parts or ()} | self._by_part(path), keep=parts is not None)

    def appended(self, table: str, df: DataFrame, gate: Gate | None = None, group: str = "") -> Release:
        """Rows added to a table without parts; ``group`` names a set of its folders."""
        held = self.places.get(table, {}).get(group, ())
        return self._with(table, {group: (*held, self._written(table, df, gate=gate))})

    def merged(self, table: str, schema: str, group: str, into: str) -> Release:
        """The folders of a group written as one folder of another."""
        release = self.appended(table, self.read(table, schema, [group]).hint("rebalance"), group=into)
        return release._with(table, {group: ()})

    def upserted(
        self, table: str, schema: str, new: DataFrame, keys: list[str], order_by: list[str], part: str | None = None,
        gate: Gate | None = None,
    ) -> Release:
        """Unknown keys added and known ones replaced, the last new row in ``order_by`` winning. With ``part``, which must
        follow from the keys, only the parts that the new rows fall into are read and written."""
        if part is None:
            return self.replaced(table, C.upsert(self.read(table, schema), new, keys, order_by), gate=gate)
        touched = [r[0] for r in new.select(part).distinct().collect()]
        if not touched:
            return self
        near = self.read(table, schema, touched)
        return self.replaced(table, C.upsert(near, new, keys, order_by), part, touched, gate)

    def dropped(self, table: str) -> Release:
        return replace(self, final=False, places={t: own for t, own in self.places.items() if t != table})

    def marked(self, **marks: object) -> Release:
        """Notes how far a source was taken in, in the same record as the rows that came of it."""
        return replace(self, final=False, marks={**self.marks, **{k: str(v) for k, v in marks.items()}})

    # ---- changes by file

    def files_with(self, table: str, schema: str, keys: DataFrame, on: list[str]) -> list[str]:
        """The files that hold any of the keys; only key columns are read."""
        if not self.paths(table):
            return []
        wanted = materialise(keys.select(*on).distinct(), "wanted-keys")
        wanted = F.broadcast(wanted) if wanted.count() <= FEW_KEYS else wanted
        return self._files(self.read(table, schema).withColumn("_file", F.col("_metadata.file_path")).join(wanted, on, "left_semi"))

    def files_where(self, table: str, schema: str, condition: Column) -> list[str]:
        """The files that hold rows of the condition; file statistics may spare most from being read."""
        if not self.paths(table):
            return []
        return self._files(self.read(table, schema).withColumn("_file", F.col("_metadata.file_path")).filter(condition))

    def _files(self, rows: DataFrame) -> list[str]:
        return sorted({plain(r[0]) for r in rows.select("_file").distinct().collect()})

    def rewritten(
        self, table: str, schema: str, files: list[str], change: Callable[[DataFrame], DataFrame], part: str | None = None,
        gate: Gate | None = None,
    ) -> Release:
        """The rows of some files replaced by what ``change`` makes of them; all other files stay as they are. ``part``
        is named where the table has parts."""
        touched, own, rest = set(files), self.places.get(table, {}), {}
        for name, paths in own.items():
            kept = []
            for path in paths:
                inside = {f for f in touched if f == plain(path) or f.startswith(f"{plain(path)}/")}
                if not inside:
                    kept.append(path)
                elif plain(path) not in inside:  # a folder of which some files stay
                    kept += sorted({plain(f) for f in self.spark.read.schema(schema).parquet(path).inputFiles()} - inside)
            rest[name] = tuple(kept)
        near = self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)
        new = change(near)
        path = self._written(table, new if part else new.hint("rebalance"), part, gate)
        for name, paths in (self._by_part(path) if part else {"": (path,)}).items():
            rest[name] = (*rest.get(name, ()), *paths)
        return self._with(table, rest, keep=False)

    def rows_updated(
        self, table: str, schema: str, updates: DataFrame, key: str, column: str, order_by: list[str], part: str | None = None
    ) -> tuple[Release, DataFrame]:
        """``changes.batch_update`` on the files that hold listed keys, and its report."""
        files = self.files_with(table, schema, updates, [key])
        near = self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)
        report = C.batch_update(near, updates, key, column, order_by)[1]
        if not files:
            return self, report
        return self.rewritten(table, schema, files, lambda rows: C.batch_update(rows, updates, key, column, order_by)[0], part), report

    def rows_deleted(self, table: str, schema: str, condition: Column, part: str | None = None) -> Release:
        """Rows of the condition gone; files without any stay."""
        files = self.files_where(table, schema, condition)
        return self.rewritten(table, schema, files, lambda rows: C.delete_where(rows, condition), part) if files else self

    def rows_replaced(self, table: str, schema: str, rows: DataFrame, keys: list[str], part: str | None = None) -> Release:
        """Rows of the given keys replaced by the given rows, which are added also where there were none."""
        files = self.files_with(table, schema, rows, keys)
        return self.rewritten(table, schema, files, lambda near: C.replace_by_key(near, rows, keys), part)

    # ---- records

    def saved(self, final: bool = True) -> Release:
        """Writes the record: from then on the state is in force (``final``), or a draft for the next run to go on from."""
        number = max(self.number, newest(self.spark, self.root)) + 1
        rows = [(_PLACE, t, part, p) for t, own in self.places.items() for part, paths in own.items() for p in paths]
        rows += [(_MARK, "", name, value) for name, value in self.marks.items()]
        path = f"{self.root}/records/number={number}/final={'true' if final else 'false'}"
        self.spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("errorifexists").parquet(path)
        return replace(self, number=number, final=final)


def _records(spark: SparkSession, root: str) -> DataFrame:
    spark.createDataFrame([(_MARK, "", "", "")], RECORD).coalesce(1).write.mode("ignore").parquet(f"{root}/records/number=0/final=true")
    return spark.read.schema(f"{RECORD}, number BIGINT, final BOOLEAN").parquet(f"{root}/records")


def newest(spark: SparkSession, root: str) -> int:
    return _records(spark, root).agg(F.max("number")).first()[0]


def _state(spark: SparkSession, root: str, drafts: bool) -> Release:
    records = _records(spark, root)
    known = records if drafts else records.filter("final")
    number = known.agg(F.max("number")).first()[0]
    places: dict[str, dict[str, tuple[str, ...]]] = {}
    marks, final = {}, True
    for r in records.filter(F.col("number") == number).collect():
        final = r["final"]
        if r["kind"] == _PLACE:
            own = places.setdefault(r["table"], {})
            own[r["part"]] = (*own.get(r["part"], ()), r["path"])
        elif r["part"]:
            marks[r["part"]] = r["path"]
    return Release(spark, root.rstrip("/"), number, final, places, marks)


def current(spark: SparkSession, root: str) -> Release:
    """What readers see: the state of the latest final record."""
    return _state(spark, root, drafts=False)


def draft(spark: SparkSession, root: str) -> Release:
    """Where a writer goes on: the latest record, be it final or what an unfinished run left."""
    return _state(spark, root, drafts=True)


def follow(release: Release, table: str, name: str, part: str | None = None, before: Release | None = None) -> None:
    """Points the catalog table ``name`` at the state of the record, for readers that do not know of records: these see
    table after table change, and a repeat completes it. ``before`` tells which parts need no change."""
    spark, old = release.spark, before.places.get(table, {}) if before else {}
    now = release.places.get(table, {})
    if part is None:
        (path,) = release.paths(table) or [f"{release.root}/data/{table}/empty"]
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        changed = [p for p in now if old.get(p) != now[p]]
        for p in changed:
            (path,) = now[p]
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({part} = '{p}')")
            spark.sql(f"ALTER TABLE {name} PARTITION ({part} = '{p}') SET LOCATION '{path}'")
        for p in set(old) - set(now):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({part} = '{p}')")
    spark.catalog.refreshTable(name)


@dataclass
class Gate:
    """Checks that the write itself counts, so that no second scan is needed.

    Fewer rows than ``least``, or more than ``most`` that break any one of ``rules``, and the load stops before a
    record names what was written. ``seen`` holds the counts of the last write."""

    rules: list[Rule] = field(default_factory=list)
    least: int = 1
    most: int = 0
    seen: dict[str, int] = field(default_factory=dict)
    _watch: Observation | None = None

    def watch(self, df: DataFrame) -> DataFrame:
        self._watch = Observation(f"gate-{uuid.uuid4().hex}")
        broken = [F.count_if(~F.coalesce(r.holds, F.lit(False))).alias(f"rule_{i}") for i, r in enumerate(self.rules)]
        return df.observe(self._watch, F.count(F.lit(1)).alias("n_rows"), *broken)

    def check(self, table: str) -> None:
        found = self._watch.get
        broken = {r.message: found[f"rule_{i}"] for i, r in enumerate(self.rules)}
        self.seen = {"rows": found["n_rows"], **broken}
        wrong = [f"{message} ({n} rows)" for message, n in broken.items() if n > self.most]
        if found["n_rows"] < self.least:
            wrong.append(f"{found['n_rows']} rows, at least {self.least} expected")
        if wrong:
            raise GateError(f"{table}: {'; '.join(wrong)}")


def unnamed(spark: SparkSession, root: str, keep: int = 10) -> list[str]:
    """Folders and record folders that neither the latest ``keep`` records nor a newer draft need any more."""
    import pyarrow.fs as fs

    store, base = fs.FileSystem.from_uri(plain(root))
    records = _records(spark, root)
    last = newest(spark, root)
    needed = {re.sub(r"^file:/+", "/", r[0]) for r in records.filter(F.col("number") > last - keep).select("path").distinct().collect()}
    folders = [
        f.path for table in store.get_file_info(fs.FileSelector(f"{base}/data", allow_not_found=True)) if not table.is_file
        for f in store.get_file_info(fs.FileSelector(table.path))
    ]
    old = [f for f in folders if not any(n == f or n.startswith(f + "/") for n in needed)]
    numbers = store.get_file_info(fs.FileSelector(f"{base}/records"))
    return old + [f.path for f in numbers if (m := re.search(r"/number=(\d+)$", f.path)) and 0 < int(m[1]) <= last - keep]


def expire(spark: SparkSession, root: str, keep: int = 10) -> int:
    """Deletes what ``unnamed`` lists, in any store that Arrow can open, and tells how many folders went. Not to be run beside a
    writer, whose folders no record names yet; readers of older states must have ended."""
    import pyarrow.fs as fs

    store, _ = fs.FileSystem.from_uri(plain(root))
    gone = unnamed(spark, root, keep)
    for path in gone:
        store.delete_dir(path)
    return len(gone)
