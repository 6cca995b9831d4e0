"""A commit log for tables in a folder: what is written aside counts once a version names it.

A version is one small file, written under another name and published by a step that either creates the whole file or
finds that the name is taken: a rename without overwrite (a hard link on a local disk).  So of two writers of a
version one wins, and one that dies leaves nothing that counts.  The other reads what came between, and publishes the
next version if what it has written still holds, or makes it anew.

A batch has a name and counts once.  Every SNAPSHOT_EVERY versions the list of what counts is written down with a marker
for each batch so far; a reader starts there, so a commit costs what the batch and the last few versions cost, not the history.

The rename has to be atomic, as in HDFS and in local and shared file systems; a bare object store is not enough.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import os
import urllib.parse
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

SNAPSHOT_EVERY = 16


@dataclass(frozen=True)
class Part:
    """A folder that counts, the version that added it, and what its writer notes about it."""

    folder: str
    version: int
    note: dict = field(default_factory=dict)


@dataclass(frozen=True)
class State:
    version: int
    parts: tuple[Part, ...]
    #: (version, kind, batch) of the versions since the last snapshot.
    recent: tuple[tuple[int, str, str | None], ...]

    def since(self, version: int) -> list[str] | None:
        """Kinds of the versions after one; None if some of them are behind the snapshot."""
        kinds = [kind for v, kind, _ in self.recent if v > version]
        return kinds if len(kinds) == self.version - version else None


class CommitLog:
    """The log of the table in the folder ``path`` of a store that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str, snapshot_every: int = SNAPSHOT_EVERY):
        self.spark, self.path, self.snapshot_every = spark, path.rstrip("/"), snapshot_every

    def place(self, name: str) -> str:
        return f"{self.path}/{name}"

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.place(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _read(self, name: str) -> dict | None:
        fs, path = self._at(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except json.JSONDecodeError:
            return None
        finally:
            stream.close()

    def _hint(self) -> dict:
        """The last snapshot there was, as far as it can be read: it is overwritten in place, and only saves time."""
        try:
            return self._read("_log/last.json") or {}
        except Exception:
            return {}

    def _write(self, name: str, text: str) -> None:
        fs, path = self._at(name)
        out = fs.create(path, True)
        out.write(text.encode())
        out.close()

    def publish(self, name: str, content: dict) -> bool:
        """Create the file whole, or find that the name is taken."""
        content = content | {"by": uuid.uuid4().hex}
        aside = f"_log/aside-{content['by']}"
        self._write(aside, json.dumps(content))
        fs, source = self._at(aside)
        _, target = self._at(name)
        fs.mkdirs(target.getParent())
        try:
            if fs.getUri().getScheme() == "file":
                local = lambda p: urllib.parse.unquote(urllib.parse.urlparse(p.toUri().toString()).path)
                try:
                    os.link(local(source), local(target))
                    return True
                except FileExistsError:
                    return False
            jvm = self.spark._jvm
            none = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
            full = fs.makeQualified(source)
            try:
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(full.toUri(), self.spark._jsc.hadoopConfiguration()).rename(full, fs.makeQualified(target), none)
                return True
            except Exception:
                # Taken by another, or published by us before the answer was lost.
                there = self._read(name)
                if there is None:
                    raise
                return there.get("by") == content["by"]
        finally:
            with contextlib.suppress(Exception):
                fs.delete(source, False)

    @staticmethod
    def _version(n: int) -> str:
        return f"_log/v{n:020d}.json"

    @staticmethod
    def _marker(batch: str) -> str:
        return f"_log/batches/{hashlib.sha256(batch.encode()).hexdigest()}.json"

    def state(self) -> State:
        """What counts now."""
        hint = self._hint()
        start = self._read(f"_log/s{hint['version']:020d}.json") if "version" in hint else None
        start = start or {"version": 0, "parts": []}
        parts = {p[0]: Part(*p) for p in start["parts"]}
        version, recent = start["version"], []
        while (entry := self._read(self._version(version + 1))) is not None:
            version += 1
            for folder in entry["remove"]:
                parts.pop(folder, None)
            for folder, note in entry["add"]:
                parts[folder] = Part(folder, version, note)
            recent.append((version, entry["kind"], entry["batch"]))
        return State(version, tuple(parts.values()), tuple(recent))

    def known(self, batch: str, state: State | None = None) -> bool:
        fs, path = self._at(self._marker(batch))
        return fs.exists(path) or any(b == batch for _, _, b in (state or self.state()).recent)

    def _after(self, version: int) -> None:
        if version % self.snapshot_every:
            return
        state = self.state()
        if state.version != version:
            return  # a later snapshot will do
        for v, _, batch in state.recent:
            if batch is not None:
                self.publish(self._marker(batch), {"version": v})
        self.publish(f"_log/s{version:020d}.json", {"version": version, "parts": [[p.folder, p.version, p.note] for p in state.parts]})
        self._write("_log/last.json", json.dumps({"version": version}))

    def discard(self, folders: list[str]) -> None:
        for folder in folders:
            fs, path = self._at(folder)
            fs.delete(path, True)

    def update(
        self,
        batch: str | None,
        make: Callable[[State], tuple[list[tuple[str, dict]], list[str]] | None],
        holds: Callable[[State, State], bool] = lambda before, after: False,
        kind: str = "batch",
    ) -> bool:
        """Commit what ``make`` writes aside for a state: folders to add (with notes) and folders to remove; None to give up.

        False if the batch was there before, or given up.  When others have committed meanwhile, what was made is kept if
        ``holds`` (state it was made for, state now), and is made anew if not.
        """
        while True:
            state = self.state()
            if batch is not None and self.known(batch, state):
                return False
            made = make(state)
            if made is None:
                return False
            add, remove = made
            now = state
            while True:
                entry = {"version": now.version + 1, "kind": kind, "batch": batch, "add": [[f, n] for f, n in add], "remove": remove}
                if self.publish(self._version(now.version + 1), entry):
                    self._after(now.version + 1)
                    return True
                now = self.state()
                if batch is not None and self.known(batch, now):
                    self.discard([f for f, _ in add])
                    return False
                if not holds(state, now):
                    self.discard([f for f, _ in add])
                    break


def fresh_part() -> str:
    return f"data-{uuid.uuid4().hex}"
