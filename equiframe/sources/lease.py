"""One writer a table: a lease file beside it.

``lease(spark, path)`` is held for a whole write.  The file names its owner
and until when it holds; a thread renews it while the block runs, so that only
a writer whose driver is lost lets it run out.  Then the next writer takes it
over (the rename of the old file succeeds once) and finishes what was left.
``check`` is called before anything is put in place: a writer that was cut off
for longer than its lease must not go on.  Readers need no lease.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from equiframe.sources import files

SECONDS = 120.0


class TableBusy(RuntimeError):
    """Another writer holds the table's lease."""


class LeaseLost(RuntimeError):
    """The lease ran out under its writer and another one took it."""


def lease_file(path: str) -> str:
    return f"{path.rstrip('/')}._lease"


class Lease:
    def __init__(self, spark: SparkSession, path: str, seconds: float = SECONDS):
        self.spark, self.path, self.file, self.seconds = spark, path, lease_file(path), seconds
        self.owner = uuid.uuid4().hex
        self._stop = threading.Event()

    def _text(self) -> str:
        return json.dumps({"owner": self.owner, "until": time.time() + self.seconds})

    def _held(self) -> dict | None:
        text = files.read_text(self.spark, self.file)
        if text is None:
            return None
        try:
            return json.loads(text)
        except ValueError:  # created, not yet written: as if just taken
            return {"owner": None, "until": time.time() + self.seconds}

    def acquire(self) -> None:
        for _ in range(3):
            if files.write_text(self.spark, self.file, self._text(), replace=False):
                threading.Thread(target=self._renew, daemon=True).start()
                return
            held = self._held()
            if held is not None and held["until"] > time.time():
                raise TableBusy(f"{self.path} is being written (lease of {held['owner']})")
            if held is not None:  # run out: of several that find it so, one moves it away
                files.move(self.spark, self.file, gone := f"{self.file}-{uuid.uuid4().hex}")
                files.delete(self.spark, gone)
        raise TableBusy(f"{self.path}: the lease changes hands")

    def check(self) -> None:
        held = self._held()
        if held is None or held["owner"] != self.owner:
            raise LeaseLost(f"{self.path}: another writer took the lease")

    def _renew(self) -> None:
        while not self._stop.wait(self.seconds / 4):
            try:
                self.check()
                if not self._stop.is_set():
                    files.write_text(self.spark, self.file, self._text(), replace=True)
            except Exception:  # the next check tells the writer
                return

    def release(self) -> None:
        self._stop.set()
        held = self._held()
        if held is not None and held["owner"] == self.owner:
            files.delete(self.spark, self.file)


_HELD: dict[tuple[str, int], Lease] = {}


@contextmanager
def lease(spark: SparkSession, path: str) -> Iterator[Lease]:
    """Hold the lease of the table at ``path``; within it the same thread may ask again."""
    key = (path.rstrip("/"), threading.get_ident())
    if key in _HELD:
        yield _HELD[key]
        return
    mine = Lease(spark, path)
    mine.acquire()
    _HELD[key] = mine
    try:
        yield mine
    finally:
        del _HELD[key]
        mine.release()
