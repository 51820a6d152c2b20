"""Full refresh: load every source, publish every document, log both."""

from __future__ import annotations

import threading
import traceback
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor, TimeoutError
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession

from statmart import codes, schemas
from statmart.operators.lineage import SourceMeta, load_record, run_event
from statmart.operators.rollup import period_text
from statmart.plans.documents import Export, export_all
from statmart.sinks import append_rows, logs, replace_slice, replace_table, shape_for
from statmart.sinks.rejects import Rejects, TooManyRejects, keep_rejects
from statmart.sinks.tables import Replaced
from statmart.sources.warehouse import MissingSource, Warehouse, table_path

#: Sources that are loaded at a time; their jobs share the cluster.
WORKERS = 4
#: Seconds a cancelled source gets to come back before it is left behind.
GRACE = 30.0


@dataclass(frozen=True)
class Built:
    """Rows of a source, and what was wrong in its extract."""

    rows: DataFrame
    rejects: Rejects | None = None


@dataclass(frozen=True)
class Load:
    """One source: what it is called, where its rows go, and how they are made.

    ``build`` returns the rows, None when the source has no usable resource.
    ``period`` names the column the reference period is read from. A source
    that ``needs_rows`` counts as missing when its extract has none. More than
    ``most_rejects`` malformed rows fail the load.
    """

    meta: SourceMeta
    table: schemas.Table
    build: Callable[[], DataFrame | Built | None]
    constants: Mapping[str, Column | object] = field(default_factory=dict)
    period: str | None = None
    optional: bool = False
    needs_rows: bool = False
    most_rejects: int = 0


@dataclass
class Refresh:
    """What a refresh did."""

    run_id: str
    rows: dict[str, int] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)
    published: list[str] = field(default_factory=list)
    rejected: dict[str, int] = field(default_factory=dict)


class TimedOut(RuntimeError):
    """A source took longer than it may."""


@dataclass(frozen=True)
class Loaded:
    """What one load wrote, and how many rows of its extract it left out."""

    written: Replaced
    rejected: int = 0


def load_one(spark: SparkSession, root: str, load: Load, run_id: str = "", check: Callable[[], None] | None = None) -> Loaded:
    """Load one source; without rows the old ones stay in place.

    The period is that of the rows of this load, whatever else its table holds.
    Malformed rows of the extract are counted while it is read; if there are
    any, they are kept beside the table, and the load fails if they are too
    many. ``check`` may still refuse the load when all is written.
    """
    built = load.build()
    if built is None:
        raise MissingSource(f"no resource found for {load.meta.dataset_key}")
    built = built if isinstance(built, Built) else Built(built)
    rejected = 0

    def admit(written: Replaced) -> None:
        nonlocal rejected
        if written.rows == 0 and load.needs_rows:
            raise MissingSource(f"no resource found for {load.meta.dataset_key}")
        if built.rejects is not None and built.rejects.seen():
            rejected = keep_rejects(spark, root, run_id, load.meta.dataset_key, built.rejects)
            if rejected > load.most_rejects:
                raise TooManyRejects(f"{rejected} malformed rows, {load.most_rejects} allowed; they are kept in {schemas.REJECTS.name}")
        if check is not None:
            check()

    shaped = shape_for(built.rows, load.table, load.constants)
    path = table_path(root, load.table.name)
    period = period_text(load.period, codes.NO_PERIOD) if load.period else None
    if load.table.slice_by:
        written = replace_slice(shaped, path, load.table.slice_by, load.table, period, admit)
    else:
        written = replace_table(shaped, path, load.table, keep_if_empty=True, period=period, check=admit)
    return Loaded(written, rejected)


def _isolated(spark: SparkSession, root: str, run_id: str, load: Load, seconds: float | None) -> Loaded:
    """A load whose jobs carry a tag of their own; when its time is up they are cancelled, and it cannot count any more."""
    tag = f"load-{uuid.uuid4().hex}"
    late = threading.Event()

    def give_up() -> None:
        late.set()
        spark.sparkContext.cancelJobsWithTag(tag)

    def check() -> None:
        if late.is_set():
            raise TimedOut(f"not done after {seconds:g} s")

    timer = threading.Timer(seconds, give_up) if seconds is not None else None
    spark.sparkContext.addJobTag(tag)
    if timer:
        timer.daemon = True
        timer.start()
    try:
        return load_one(spark, root, load, run_id, check)
    except Exception:
        check()
        raise
    finally:
        if timer:
            timer.cancel()
        spark.sparkContext.removeJobTag(tag)


def _result(future: Future, started: threading.Event, seconds: float | None) -> Loaded:
    """What a load returns; one that hangs outside of its Spark jobs is left behind."""
    if seconds is None:
        return future.result()
    started.wait()
    try:
        return future.result(timeout=seconds + GRACE)
    except TimeoutError:
        raise TimedOut(f"not done after {seconds:g} s, and not to be cancelled") from None


def load_all(spark: SparkSession, root: str, run_id: str, loads: Sequence[Load], workers: int = WORKERS,
             seconds: float | None = None) -> Refresh:
    """Load all sources, several at a time; one that fails, takes longer than ``seconds`` or cannot be logged is recorded and does not stop the others.

    Records are written in the order of the loads, each as soon as it and those before it are done.
    """
    done = Refresh(run_id)
    log = table_path(root, schemas.LOADS.name)
    # Threads that hang must not keep the program alive, and must not take a place from others.
    pool = ThreadPoolExecutor(max_workers=max(1, workers if seconds is None else len(loads)), thread_name_prefix="load")
    places = threading.Semaphore(max(1, workers))
    running = []
    for load in loads:
        started = threading.Event()

        def run(load: Load = load, started: threading.Event = started) -> Loaded:
            with places:
                started.set()
                return _isolated(spark, root, run_id, load, seconds)

        running.append((load, started, pool.submit(inheritable_thread_target(spark)(run))))
    for load, started, future in running:
        key = load.meta.dataset_key
        period: str | None = None
        notes: str | None = None
        try:
            loaded = _result(future, started, seconds)
            done.rows[key] = loaded.written.rows
            if loaded.rejected:
                done.rejected[key] = loaded.rejected
                notes = f"{loaded.rejected} malformed rows left out"
            if loaded.written.rows:
                status, period = "success", loaded.written.period
            else:
                status, notes = "skipped", "the extract is empty"
                done.skipped[key] = notes
        except MissingSource as missing:
            status, notes = ("skipped" if load.optional else "failed"), str(missing)
            (done.skipped if load.optional else done.failures)[key] = notes
        except Exception as error:  # noqa: BLE001 - any failure of one source is recorded
            status, notes = "failed", "".join(traceback.format_exception(error))
            done.failures[key] = str(error)
        try:
            append_rows(load_record(spark, run_id, load.meta, status, notes, period), log)
        except Exception as error:  # noqa: BLE001 - the rows are in place; the missing record is a failure of its own
            done.failures[key] = f"loaded without a record: {error}" if status == "success" else f"{notes}; no record: {error}"
    pool.shutdown(wait=False)
    return done


def warehouse(spark: SparkSession, root: str) -> Warehouse:
    """All tables of the warehouse."""
    return Warehouse(spark, root)


def refresh(spark: SparkSession, root: str, loads: Sequence[Load], folder: str | None, export: Export | None = None,
            now: Callable[[], datetime] = datetime.now, workers: int = WORKERS, seconds: float | None = None) -> Refresh:
    """Load all sources, publish all documents and log the run.

    Without ``loads`` the tables are published as they are, without ``folder``
    nothing is published.  A failing publication fails the run, and readers keep
    the set of documents published before. Logs that have become many files are
    put together at the end.
    """
    run_id, started = uuid.uuid4().hex, now()
    log = table_path(root, schemas.RUNS.name)
    append_rows(run_event(spark, run_id, started, "running"), log)
    try:
        done = load_all(spark, root, run_id, loads, workers, seconds)
        if folder is not None:
            export = export or Export(as_of=started.year)
            export = replace(export, generated_at=now(), failures=done.failures)
            done.published = export_all(warehouse(spark, root), folder, export, run_id)
    except Exception as error:
        append_rows(run_event(spark, run_id, started, "failed", now(), notes=f"{error}\n{traceback.format_exc()}"), log)
        raise
    fetched = [key for key, rows in done.rows.items() if rows]
    notes = str(done.failures) if done.failures else None
    append_rows(run_event(spark, run_id, started, "success", now(), fetched, notes), log)
    for table in (schemas.LOADS, schemas.RUNS):
        logs.compact(spark, table_path(root, table.name), table.schema, logs.MANY_FILES)
    return done
