"""Folders of the shared file system, addressed as Spark addresses them."""

from __future__ import annotations

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the path in it; a path without scheme is local."""
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def remove_folder(folder: str) -> None:
    """Remove a folder with all that is in it; one that is not there is left alone."""
    system, path = opened(folder)
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)


def folder_exists(folder: str) -> bool:
    system, path = opened(folder)
    return system.get_file_info(path).type == fs.FileType.Directory
