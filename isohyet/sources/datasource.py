"""The ``gridded`` data source: ``spark.read.format("gridded").option("path", folder).load()``.

A folder of granules (classic NetCDF, GRIB2, GeoTIFF; gzipped or zipped as well),
each with a day in its name, read as tidy rows (date, variable, time, lat, lon,
value).  What is asked for is cut at the source: days prune the list of files, so
that others are not opened; variables, the box and times are cut inside a file
before its values are unpacked.

* The options ``start`` and ``end`` (days, both included), ``variables`` ("a,b") and
  ``box`` ("west,south,east,north") say it when the table is loaded.
* ``option("pushdown", "true")`` takes it from the filters of the query.  Spark
  4.1.2 keeps what was pushed with the loaded table, and uses it again in every
  later query of the same DataFrame, whatever that one filters: load anew for each
  query then.  This is why it is off unless asked for.

A read task is a file, or with ``variables`` a (file, variable) pair; files are never
merged, so a task holds one.  The readers open files as Python does, so the folder
must be mounted on all machines; where only Spark reaches it,
``decode.decode(decode.files(...))`` gives the same rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, time, timedelta

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from isohyet.operators.spatial import BoundingBox
from isohyet.sources.decode import Window, any_rows

COLUMNS = "date date, variable string, time timestamp_ntz, lat double, lon double, value double"
EVERYWHERE = BoundingBox(-1e9, -1e9, 1e9, 1e9)


@dataclass
class Granule(InputPartition):
    path: str
    day: date
    window: Window

    def __init__(self, path: str, day: date, window: Window) -> None:
        super().__init__(path)
        self.path, self.day, self.window = path, day, window


def naive(at: datetime | date) -> datetime:
    """The instant of a pushed value without a zone; days are their midnights."""
    if not isinstance(at, datetime):
        return datetime.combine(at, time())
    return at.replace(tzinfo=None)


class GriddedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options.get("path") or ""
        if not self.path:
            raise ValueError("gridded needs a path")
        self.pattern = re.compile(options.get("datepattern", r"(\d{8})"))
        self.bad = options.get("mode", "permissive").lower()
        if self.bad not in ("permissive", "failfast"):
            raise ValueError("mode must be permissive or failfast")
        self.named = tuple(v.strip() for v in options["variables"].split(",")) if options.get("variables") else None
        self.first = date.fromisoformat(options["start"]) if options.get("start") else date.min
        self.last = date.fromisoformat(options["end"]) if options.get("end") else date.max
        box = BoundingBox(*map(float, options["box"].split(","))) if options.get("box") else None
        self.window = Window(variables=self.named, box=box)

    def partitions(self) -> Sequence[Granule]:
        """The files of the wanted days, in the order of day and path; none in the folder at all is an error."""
        found, any_file = [], False
        for folder, _, names in os.walk(self.path):
            for name in names:
                told = self.pattern.search(name)
                if not told or name.startswith((".", "_")):
                    continue
                try:
                    day = datetime.strptime(told[1], "%Y%m%d").date()
                except ValueError:
                    continue
                any_file = True
                if self.first <= day <= self.last:
                    found.append((day, os.path.join(folder, name)))
        if not any_file:
            raise ValueError(f"no granules in {self.path}")
        if self.window.variables == ():
            return []
        each = [replace(self.window, variables=(v,)) for v in self.window.variables] if self.named and self.window.variables else [self.window]
        return [Granule(path, day, w) for day, path in sorted(found) for w in each]

    def read(self, partition: Granule) -> Iterator[pa.RecordBatch]:
        with open(partition.path, "rb") as file:
            content = file.read()
        try:
            for made in any_rows(partition.path, content, partition.window):
                yield pa.RecordBatch.from_arrays([pa.array([partition.day] * made.num_rows, pa.date32()), *made.columns], names=["date", *made.schema.names])
        except Exception as error:
            if self.bad == "failfast":
                raise ValueError(f"{partition.path}: {error}") from error


class PushingReader(GriddedReader):
    """The reader that learns from the filters of a query."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Narrows days and the window by each filter that it knows; all are given back, for bounds of a file's rows are no more than bounds."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            value = getattr(f, "value", None)
            if column == "date" and isinstance(value, date):
                self._days(f, value)
            elif column == "time" and isinstance(value, datetime):
                self._times(f, naive(value))
            elif column == "variable" and isinstance(f, EqualTo):
                self._variables({value})
            elif column == "variable" and isinstance(f, In):
                self._variables(set(value))
            elif column in ("lat", "lon") and isinstance(value, int | float):
                self._box(f, column, float(value))
            yield f

    def _days(self, f: Filter, value: date) -> None:
        if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
            self.first = max(self.first, value)
        if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
            self.last = min(self.last, value)

    def _times(self, f: Filter, value: datetime) -> None:
        w = self.window
        if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
            self.window = w = replace(w, start=max(w.start or value, value))
        if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
            end = value + timedelta(microseconds=1)
            self.window = replace(w, end=min(w.end or end, end))

    def _variables(self, wanted: set[str]) -> None:
        have = self.window.variables
        self.window = replace(self.window, variables=tuple(sorted(wanted if have is None else wanted & set(have))))

    def _box(self, f: Filter, column: str, value: float) -> None:
        box = self.window.box or EVERYWHERE
        low, high = ("south", "north") if column == "lat" else ("west", "east")
        if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
            box = replace(box, **{low: max(getattr(box, low), value)})
        if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
            box = replace(box, **{high: min(getattr(box, high), value)})
        self.window = replace(self.window, box=box)


class GriddedSource(DataSource):
    """mode=permissive leaves out files that can't be read (``decode`` lists them with their errors); failfast stops."""

    @classmethod
    def name(cls) -> str:
        return "gridded"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema: object) -> GriddedReader:
        return PushingReader(self.options) if self.options.get("pushdown", "false").lower() == "true" else GriddedReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # without it a reader that could push is an error
    spark.dataSource.register(GriddedSource)
