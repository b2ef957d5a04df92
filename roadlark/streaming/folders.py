"""Tables kept in folders by their partition columns, changed together folder by folder.

A change is prepared as a whole in a stage folder: the new content of every folder that it touches,
in all tables.  Only when the stage is complete is it marked as ready; then its folders are renamed
into the tables, so no row is written twice.  A change that stops before the mark leaves the tables
as they were; one that stops after it is finished by the next change (``recover``), and repeating any
of its steps does no harm.  So reads need no versions and no ranking: what stands in the tables is
the newest state.  The file system has to rename a folder as a whole.

One writer at a time; a reader that needs all tables at the same state reads between changes.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlark.sources import files
from roadlark.streaming.log import widened

# A change that touches more folders than this reads without folder pruning.
MAX_PRUNED = 1000
_WRITES = 4


def in_parallel(spark: SparkSession, steps: Sequence[Callable[[], None]]) -> None:
    """Run independent writes side by side: small ones leave most of a cluster idle."""
    with ThreadPoolExecutor(_WRITES) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            done.result()


def same_values(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & a[c].eqNullSafe(b[c])
    return condition


def _any(conditions: Sequence[Column]) -> Column:
    """Conditions joined by OR as a balanced tree, so that many do not nest deeply."""
    if len(conditions) < 2:
        return conditions[0] if conditions else F.lit(False)
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def among(columns: Sequence[str], cells: Collection[tuple]) -> Column:
    """Whether the columns hold one of the cells' values, missing ones included; never NULL.

    On partition columns Spark reads the folders of these cells only, and no join is needed.
    """
    if not columns:
        return F.lit(True)
    first, below = F.col(columns[0]), {}
    for value, *rest in cells:
        below.setdefault(value, set()).add(tuple(rest))
    alike: dict[frozenset, list] = {}
    for value, rest in below.items():
        alike.setdefault(frozenset(rest), []).append(value)

    def one_of(values: list) -> Column:
        known = first.isNotNull() & first.isin([v for v in values if v is not None])
        return known | first.isNull() if None in values else known

    return _any([one_of(values) & among(columns[1:], rest) for rest, values in alike.items()])


class FolderTables:
    """``layout``: partition columns by table name."""

    def __init__(self, spark: SparkSession, root: str, layout: Mapping[str, Sequence[str]]):
        self.spark = spark
        self.root = root.rstrip("/")
        self.layout = {name: list(columns) for name, columns in layout.items()}
        self._known: dict[tuple, tuple[T.StructType, list[tuple] | None]] = {}

    # files -------------------------------------------------------------------------------------

    def _path(self, name: str):
        return files.path(self.spark, f"{self.root}/{name}")

    def _files(self):
        return files.system(self.spark, self.root)

    def _exists(self, name: str) -> bool:
        return self._files().exists(self._path(name))

    def _delete(self, name: str) -> None:
        self._files().delete(self._path(name), True)

    def _note(self, name: str, text: str) -> None:
        files.write_text(self.spark, f"{self.root}/{name}", text)

    # reading -----------------------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self._exists(f"{name}/_schema")

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(files.read_text(self.spark, f"{self.root}/{name}/_schema")))

    def read(self, name: str) -> DataFrame:
        """The table; its schema is stored, so no file is opened for it."""
        return self.spark.read.schema(self.schema(name)).parquet(f"{self.root}/{name}")

    def staged(self, name: str) -> DataFrame:
        """A table's new content of the touched folders."""
        return self.spark.read.schema(self.schema(f"_stage/{name}")).parquet(f"{self.root}/_stage/{name}")

    def within(self, rows: DataFrame, columns: Sequence[str], inside: bool = True) -> DataFrame:
        """Rows in the folders that this change touches, told by some partition columns, or outside."""
        cells = self._cells(columns)
        if cells is not None:
            found = among(columns, cells)
            return rows.where(found if inside else ~found)
        touched = self.touched(columns)
        return rows.join(touched, same_values(rows, touched, columns), "left_semi" if inside else "left_anti")

    def pruned(self, name: str, columns: Sequence[str]) -> DataFrame:
        """The table's rows in the folders that this change touches."""
        return self.within(self.read(name), columns)

    def merged(self, name: str, within: Sequence[str]) -> DataFrame:
        """What the table will hold, after this change, in all folders that share the columns
        ``within`` with touched ones."""
        new = self.staged(name)
        if not self.exists(name):
            return new
        rest = self.within(self.pruned(name, within), self.layout[name], inside=False)
        return rest.unionByName(new, allowMissingColumns=True)

    # changing ----------------------------------------------------------------------------------

    def recover(self) -> None:
        """Finish a change that was ready, and forget one that was not."""
        self._known.clear()
        if self._exists("_stage/_ready"):
            self.finish()
        else:
            self._forget()

    def _write(self, rows: DataFrame, name: str, partition_by: Sequence[str]) -> None:
        rows.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.root}/{name}")

    def touch(self, touched: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Keep the distinct folders of a change, for all tables that lie by these columns."""
        path = f"{self.root}/_stage/_touched-{'-'.join(columns)}"
        touched.select(*columns).distinct().coalesce(1).write.mode("overwrite").parquet(path)
        return self.touched(columns)

    def narrow(self, known: Sequence[str], columns: Sequence[str]) -> None:
        """Keep a change's folders by some of the columns that they are known by."""
        cells = self._cells(known)
        if cells is None:
            self.touch(self.touched(known), columns)
            return
        places = [list(known).index(c) for c in columns]
        fields = [self._known[tuple(known)][0][c] for c in columns]
        found = dict.fromkeys(tuple(cell[k] for k in places) for cell in cells)
        self._known[tuple(columns)] = T.StructType(fields), list(found)

    def _cells(self, columns: Sequence[str]) -> list[tuple] | None:
        """The touched folders, if there are few enough to name them."""
        if tuple(columns) not in self._known:
            kept = self.spark.read.parquet(f"{self.root}/_stage/_touched-{'-'.join(columns)}")
            rows = [tuple(r) for r in kept.limit(MAX_PRUNED + 1).collect()]
            self._known[tuple(columns)] = (kept.schema, rows if len(rows) <= MAX_PRUNED else None)
        return self._known[tuple(columns)][1]

    def touched(self, columns: Sequence[str]) -> DataFrame:
        cells = self._cells(columns)
        if cells is not None:
            return self.spark.createDataFrame(cells, self._known[tuple(columns)][0])
        return self.spark.read.parquet(f"{self.root}/_stage/_touched-{'-'.join(columns)}")

    def stage(self, name: str, rows: DataFrame) -> None:
        """Prepare the new content of the touched folders of a table; those without rows go."""
        columns = self.layout[name]
        # Partition columns are read back behind the others.
        rows = rows.select(*[c for c in rows.columns if c not in columns], *columns)
        known = self.schema(name) if self.exists(name) else None
        stored = widened(known, rows.schema, columns) if known else rows.schema
        self._write(rows, f"_stage/{name}", columns)
        self._note(f"_stage/{name}/_schema", stored.json())

    def ready(self) -> None:
        """Name the folders that lose all rows, and mark the change as complete."""
        for name in self._staged_names():
            self._note(f"_stage/_emptied-{name}", "\n".join(self._emptied(name)))
        self._note("_stage/_ready", "ready")

    def finish(self) -> None:
        """Put the staged folders in place of the tables' own.  Can be repeated."""
        in_parallel(self.spark, [lambda n=n: self._place(n) for n in self._staged_names()])
        self._forget()

    def _staged_names(self) -> list[str]:
        return [n for n in self.layout if self._exists(f"_stage/{n}/_schema")]

    def _forget(self) -> None:
        self._delete("_stage")
        self._known.clear()

    def _place(self, name: str) -> None:
        if not self._exists(f"_stage/{name}"):
            return  # moved before
        if not self.exists(name):
            self._move(f"_stage/{name}", name)
            return
        self._note(f"{name}/_schema", self.schema(f"_stage/{name}").json())
        for folder in files.read_text(self.spark, f"{self.root}/_stage/_emptied-{name}").splitlines():
            self._delete(f"{name}/{folder}")
        for folder in list(self._folders(f"_stage/{name}", len(self.layout[name]))):
            self._delete(f"{name}/{folder}")
            self._move(f"_stage/{name}/{folder}", f"{name}/{folder}")
        self.spark.catalog.refreshByPath(f"{self.root}/{name}")

    def _move(self, source: str, target: str) -> None:
        self._files().mkdirs(self._path(target).getParent())
        if not self._files().rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {self.root}/{source} to {target}")

    def _folders(self, name: str, depth: int) -> Iterator[str]:
        """Partition folders, so many levels below a table's own, as relative paths."""
        for status in self._files().listStatus(self._path(name)):
            part = status.getPath().getName()
            if status.isDirectory() and "=" in part:
                if depth == 1:
                    yield part
                else:
                    yield from (f"{part}/{rest}" for rest in self._folders(f"{name}/{part}", depth - 1))

    def _folder(self, columns: Sequence[str], cell: Sequence) -> str:
        values = ("__HIVE_DEFAULT_PARTITION__" if v is None else v for v in cell)
        return "/".join(f"{c}={v}" for c, v in zip(columns, values, strict=True))

    def _emptied(self, name: str) -> list[str]:
        """Touched folders for which nothing is staged."""
        columns, cells = self.layout[name], self._cells(self.layout[name])
        # One row per touched folder.
        touched = cells if cells is not None else self.touched(columns).toLocalIterator()
        left = set(self._folders(f"_stage/{name}", len(columns)))
        return [f for f in (self._folder(columns, cell) for cell in touched) if f not in left]
