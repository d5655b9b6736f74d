"""Folders and small files, through Hadoop's file systems, so on whatever store a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fixed value: the empty file that a finished write leaves in its folder.
FINISHED = "_SUCCESS"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in ``path``, sorted; none if it does not exist. No files are listed."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(found.getPath().getName() for found in files.listStatus(place) if found.isDirectory())


def child_files(spark: SparkSession, path: str) -> dict[str, float]:
    """Names of the files directly in ``path`` and the seconds at which they were written; none if it does not exist."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return {}
    return {
        found.getPath().getName(): found.getModificationTime() / 1000 for found in files.listStatus(place) if found.isFile()
    }


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _file_system(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> bool:
    """Write a small file; False if there is one already that is not to be overwritten."""
    files, place = _file_system(spark, path)
    if not overwrite and files.exists(place):
        return False
    try:
        stream = files.create(place, overwrite)
    except Exception as error:  # another writer was faster
        if overwrite or not files.exists(place):
            raise error
        return False
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    return True


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all that is in it, if it is there."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder; one step on a file system that has renames."""
    files, place = _file_system(spark, path)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(goal.getParent())
    if not files.rename(place, goal):
        raise OSError(f"cannot move {path} to {target}")


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether the write that made the folder came to its end."""
    return exists(spark, f"{path}/{FINISHED}")


def finished_numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers N of finished folders ``name=N``, in order."""
    prefix = f"{name}="
    found = [folder for folder in child_folders(spark, path) if folder.startswith(prefix)]
    return sorted(int(folder.removeprefix(prefix)) for folder in found if is_finished(spark, f"{path}/{folder}"))
