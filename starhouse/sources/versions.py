"""Published sets of tables.

Every refresh writes a set of its own under ``<root>/sets/<name>``. It becomes the current one by a single empty file,
``<root>/_switches/<number>-<name>``: the set whose file sorts last is current. Creating an empty file is one step on
every file system, and neither its content nor a rename can be half done, so readers see the old set or the new one,
whole. Refreshes at the same time never share a folder; whichever publishes last stays.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

_SETS, _SWITCHES = "sets", "_switches"


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _files(spark: SparkSession, root: str):
    return _path(spark, root).getFileSystem(spark._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, folder: str) -> list:
    files, path = _files(spark, folder), _path(spark, folder)
    return list(files.listStatus(path)) if files.exists(path) else []


def _switches(spark: SparkSession, root: str) -> list[str]:
    return sorted(x.getPath().getName() for x in _listed(spark, f"{root}/{_SWITCHES}"))


def new_set(root: str) -> str:
    """A folder for a new set of tables; nobody reads it before :func:`publish`."""
    return f"{root.rstrip('/')}/{_SETS}/{uuid.uuid4().hex}"


def publish(spark: SparkSession, folder: str) -> None:
    """Make the set in ``folder`` the current one."""
    root, name = folder.rsplit(f"/{_SETS}/", 1)
    last = _switches(spark, root)
    number = int(last[-1].split("-")[0]) + 1 if last else 1
    _files(spark, root).create(_path(spark, f"{root}/{_SWITCHES}/{number:012d}-{name}"), False).close()


def current(spark: SparkSession, root: str) -> str:
    """The folder of the current set; ``root`` itself if nothing was ever published there.

    Whoever reads several tables asks once, and reads them all from the folder it got.
    """
    root = root.rstrip("/")
    last = _switches(spark, root)
    return f"{root}/{_SETS}/{last[-1].split('-', 1)[1]}" if last else root


def clean(spark: SparkSession, root: str, keep: int = 2, abandoned_hours: float = 72) -> list[str]:
    """Remove all published sets but the newest ``keep``, and unpublished ones untouched for so many hours; returns their names.

    Running queries on the set before still find their files. The last switch always stays, so numbers only grow.
    """
    root, files = root.rstrip("/"), _files(spark, root)
    published = [x.split("-", 1)[1] for x in _switches(spark, root)]
    stays = set(published[-max(keep, 1):])
    oldest = (time.time() - abandoned_hours * 3600) * 1000
    gone = []
    for entry in _listed(spark, f"{root}/{_SETS}"):
        name = entry.getPath().getName()
        if name not in stays and (name in published or entry.getModificationTime() < oldest):
            files.delete(entry.getPath(), True)
            gone.append(name)
    for switch in _switches(spark, root)[:-max(keep, 1)]:
        files.delete(_path(spark, f"{root}/{_SWITCHES}/{switch}"), False)
    return sorted(gone)
