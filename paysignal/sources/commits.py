"""One commit over several versioned tables.

A step that changes more than one table writes a new version of each and then one
small file that names the versions that belong together. Readers go by the latest
file, so a step that ends before it changed nothing, and its versions are passed
over by the next one. The file's number is the step's; creating it fails if another
writer was faster. The number of the last batch applied is kept with it, so that a
batch that is delivered again can be recognised.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from paysignal.sources.storage import TableStore, list_dir, read_lines, write_lines


@dataclass(frozen=True)
class Commit:
    number: int = 0
    versions: dict = field(default_factory=dict)
    batch: int | None = None
    notes: dict = field(default_factory=dict)

    def version(self, table: str) -> int | None:
        return self.versions.get(table)


class Commits:
    """The commits of ``name`` under ``<root>/_commits/<name>/``."""

    def __init__(self, store: TableStore, name: str):
        self.store = store
        self.folder = f"{store.root}/_commits/{name}"

    def current(self) -> Commit:
        done = [int(x) for x in list_dir(self.store.spark, self.folder) if x.isdigit()]
        return self.at(max(done)) if done else Commit()

    def at(self, number: int) -> Commit:
        pairs = dict(x.split("=", 1) for x in read_lines(self.store.spark, f"{self.folder}/{number:08d}"))
        batch = pairs.pop("_batch", "")
        notes = {k[1:]: pairs.pop(k) for k in list(pairs) if k.startswith("_")}
        return Commit(number, {k: int(v) for k, v in pairs.items()}, int(batch) if batch else None, notes)

    def commit(self, after: Commit, versions: dict, batch: int | None = None, **notes: str) -> Commit:
        """The commit after ``after``: its versions, with those of ``versions`` anew, and ``notes`` on this step."""
        merged = {**after.versions, **{k: v for k, v in versions.items() if v is not None}}
        batch = after.batch if batch is None else batch
        lines = [f"{k}={v}" for k, v in sorted(merged.items())] + [f"_batch={'' if batch is None else batch}"]
        lines += [f"_{k}={v}" for k, v in sorted(notes.items())]
        write_lines(self.store.spark, f"{self.folder}/{after.number + 1:08d}", lines)
        return Commit(after.number + 1, merged, batch, notes)
