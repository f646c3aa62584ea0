"""Where a table written batch by batch keeps its batches.

Every batch has a folder of its own, so that a replay replaces itself. A reader pays for every folder it lists, so a
stream's batches stand in folds of a fixed number, and a fold that gets no more batches is merged into one folder
beside the table (``plans.maintenance.compact``). Readers take the merged folder of a fold if it is complete, and the
batches otherwise. Nothing of a table is deleted. Streams learn of new batches by ``journal`` and list none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

# Batches in a fold. A reader lists at most about this many batch folders per stream, and one folder per merged fold.
FOLD = 250

# The stream of an empty table.
NO_STREAM = "none"


def batch_path(path: str, stream: str, batch: int) -> str:
    return f"{fold_path(path, stream, batch // FOLD)}/batch={batch}"


def fold_path(path: str, stream: str, fold: int) -> str:
    return f"{path}/stream={stream}/fold={fold}"


def merged_path(path: str, stream: str, fold: int) -> str:
    return fold_path(f"{path}-merged", stream, fold)


@dataclass(frozen=True)
class Fold:
    stream: str
    number: int
    merged: bool
    newest: bool


def folds(spark: SparkSession, path: str) -> list[Fold]:
    """The folds of a table, found by listing the folders above its batches, and the folders of the merged folds, only."""
    found = []
    for stream in values(spark, path, "stream"):
        numbers = sorted(int(n) for n in values(spark, f"{path}/stream={stream}", "fold"))
        beside = {int(n) for n in values(spark, f"{path}-merged/stream={stream}", "fold")}
        for number in numbers:
            # The newest merge may be under way; of the others each was complete before the next began.
            merged = number in beside and (
                number != max(beside) or exists(spark, f"{merged_path(path, stream, number)}/_SUCCESS")
            )
            found.append(Fold(stream, number, merged, number == numbers[-1]))
    return found


def complete_batches(spark: SparkSession, path: str, fold: Fold) -> list[int]:
    """The batches of a fold, without one that is being written."""
    numbers = sorted(int(n) for n in values(spark, fold_path(path, fold.stream, fold.number), "batch"))
    # Batches of a stream are written one after the other.
    if fold.newest and numbers and not exists(spark, f"{batch_path(path, fold.stream, numbers[-1])}/_SUCCESS"):
        numbers.pop()
    return numbers


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Names and sizes of the data files of a folder."""
    place, files = _file_system(spark, folder)
    found = [(s.getPath().getName(), s.getLen()) for s in files.listStatus(place)]
    return sorted((name, size) for name, size in found if not name.startswith(("_", ".")))


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.mkdirs(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


def write_file(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes a small file that readers see whole or not at all; one of the same name is replaced."""
    place, files = _file_system(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{place.getName()}.new")
    out = files.create(hidden, True)
    try:
        out.write(content)
    finally:
        out.close()
    if not files.rename(hidden, place):
        files.delete(place, False)
        if not files.rename(hidden, place):
            raise OSError(f"{path} could not be written")


def values(spark: SparkSession, path: str, level: str) -> list[str]:
    """The values of a directory level."""
    folder, files = _file_system(spark, path)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return [name.removeprefix(f"{level}=") for name in names if name.startswith(f"{level}=")]
