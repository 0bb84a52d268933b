"""Tables whose days change all at once.

Every write fills a folder of its own, ``version=<name>`` with a folder per day in it. The table is what the newest list in ``_published``
names: for each day the version that holds it. A list is one small file, renamed into place after all its rows are stored, so readers see
either all days of a write or none, and what a failed write left is never read. The list before the newest stays valid, for
readers that took it; folders that neither names are deleted. One writer at a time.
"""

import uuid

from pyspark.sql import SparkSession

LISTS, VERSION = "_published", "version="
#: Folder of a day, as the partitioned write names it, -> version that holds it.
Days = dict[str, str]


class PublishedDays:
    """The lists of a table at ``path``; lists and folders are as many as days and versions, never as rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._files = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}" if below else self.path)

    def _names(self, below: str) -> list[str]:
        at = self._at(below)
        return sorted(f.getPath().getName() for f in self._files.listStatus(at)) if self._files.exists(at) else []

    def _lists(self) -> list[str]:
        return [name for name in self._names(LISTS) if name.isdigit()]

    def _read(self, name: str) -> Days:
        stream = self._files.open(self._at(f"{LISTS}/{name}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return dict(reversed(line.split("\t")) for line in text.splitlines())

    def current(self) -> Days | None:
        """The days of the newest list; None for a table without one."""
        names = self._lists()
        return self._read(names[-1]) if names else None

    def folders(self, days: Days) -> list[str]:
        return [f"{self.path}/{VERSION}{version}/{day}" for day, version in sorted(days.items())]

    def unlisted(self) -> list[str]:
        """Day folders directly below ``path``, of tables written before there were lists."""
        return [f"{self.path}/{name}" for name in self._names("") if name.startswith("chat_date=")]

    def new_version(self) -> tuple[str, str]:
        """Name and folder of a version to be written."""
        name = f"v{uuid.uuid4().hex}"
        return name, f"{self.path}/{VERSION}{name}"

    def written(self, version: str) -> Days:
        return {day: version for day in self._names(VERSION + version) if day.startswith("chat_date=")}

    def publish(self, days: Days) -> None:
        """Make ``days`` the table, then delete what no valid list names."""
        names = self._lists()
        number = int(names[-1]) + 1 if names else 1
        made = self._at(f"{LISTS}/.{uuid.uuid4().hex}")
        out = self._files.create(made, True)
        out.write(bytearray("".join(f"{version}\t{day}\n" for day, version in sorted(days.items())), "utf-8"))
        out.close()
        if not self._files.rename(made, self._at(f"{LISTS}/{number:012d}")):
            raise OSError(f"list {number} of {self.path} exists: another writer is at work")
        self._drop_unused()

    def _drop_unused(self) -> None:
        *old, previous, newest = ["", *self._lists()]
        valid = [self._read(name) for name in (previous, newest) if name]
        used = {(version, day) for days in valid for day, version in days.items()}
        versions = {version for version, _ in used}
        for name in self._names(""):
            version = name.removeprefix(VERSION)
            if name.startswith(VERSION) and version not in versions:
                self._files.delete(self._at(name), True)
            elif name.startswith(VERSION):
                for day in set(self.written(version)) - {d for v, d in used if v == version}:
                    self._files.delete(self._at(f"{name}/{day}"), True)
        for name in filter(None, old):
            self._files.delete(self._at(f"{LISTS}/{name}"), False)
