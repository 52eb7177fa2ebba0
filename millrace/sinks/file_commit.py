"""Replacing some files of a folder by others, all or none.

New files are written completely to a hidden folder beside the data. A journal then says
which files come and which go; writing it decides that the change takes place. Only then
are the new files moved in, one rename each, and the others deleted. A run that stops
before the journal is complete changed nothing, and its hidden folder is deleted by the
next one; a run that stops later is finished by the next one. Files that are not named
keep their names and times.

Readers that list the folder while files are being moved may see old and new rows side by
side. On stores whose renames copy, the new files, and no others, are copied once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from ..runtime import child_names, delete, file_system, read_text, write_text
from .published import file_names

JOURNAL, STAGE = "_merge.json", "_merge-"
#: Renames and deletions under way at a time; each is one call to the store.
AT_ONCE = 16


class FileCommit:
    """Changes to the files under ``folder``; one run at a time."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def publish(self, write: Callable[[str], None], gone: Iterable[str]) -> None:
        """Add the files that ``write`` puts into the folder it is given, in the layout
        they are to have, and delete the files ``gone``, given by their paths below."""
        self.recover()
        stage = f"{STAGE}{uuid.uuid4().hex}"
        try:
            write(f"{self.folder}/{stage}")
        except BaseException:
            delete(self.spark, f"{self.folder}/{stage}")
            raise
        change = {"stage": stage, "come": file_names(self.spark, f"{self.folder}/{stage}"), "go": sorted(gone)}
        write_text(self.spark, f"{self.folder}/{JOURNAL}", json.dumps(change))
        self._apply(change)

    def recover(self) -> None:
        """Finish a decided change of a run that stopped, and forget an undecided one."""
        names = child_names(self.spark, self.folder)
        if JOURNAL in names:
            try:
                change = json.loads(read_text(self.spark, f"{self.folder}/{JOURNAL}"))
            except ValueError:
                delete(self.spark, f"{self.folder}/{JOURNAL}")
            else:
                self._apply(change)
        for name in names:
            if name.startswith(STAGE):
                delete(self.spark, f"{self.folder}/{name}")

    def _apply(self, change: dict) -> None:
        """Can be stopped and begun again at any point."""
        with ThreadPoolExecutor(AT_ONCE) as pool:
            list(pool.map(lambda name: self._move_in(change["stage"], name), change["come"]))
            list(pool.map(lambda name: delete(self.spark, f"{self.folder}/{name}"), change["go"]))
        delete(self.spark, f"{self.folder}/{change['stage']}")
        delete(self.spark, f"{self.folder}/{JOURNAL}")

    def _move_in(self, stage: str, name: str) -> None:
        files, new = file_system(self.spark, f"{self.folder}/{stage}/{name}")
        target = file_system(self.spark, f"{self.folder}/{name}")[1]
        files.mkdirs(target.getParent())
        if not files.exists(target) and not files.rename(new, target):
            raise OSError(f"cannot move {new} to {target}")
