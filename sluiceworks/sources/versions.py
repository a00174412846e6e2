"""Versions of a dataset in one folder: written aside, committed by a pointer, removed when replaced.

``<folder>/version-<number>-<id>/`` holds data, ``<folder>/_commits/<number>.json`` makes one version the current one.
Writing a version touches nothing that is current, so a writer that dies leaves the last one as it was. Numbers are
claimed by creating the pointer file, which only one writer can; another one with the same number has lost and
says so. A pointer that was not written to its end does not count.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from sluiceworks.sources.files import Files

COMMITS = "_commits"


class OvertakenError(RuntimeError):
    """Another writer committed its version first; the dataset is as that one left it."""


@dataclass(frozen=True)
class Commit:
    number: int
    version: str
    about: dict[str, Any]

    def path(self, folder: str) -> str:
        return f"{folder.rstrip('/')}/{self.version}"


def commits(spark: SparkSession, folder: str) -> list[Commit]:
    """All commits of a dataset, latest last."""
    files, found = Files(spark, folder), []
    for name in files.names(COMMITS):
        try:
            content = json.loads(files.read(f"{COMMITS}/{name}"))
        except ValueError:
            continue
        found.append(Commit(content["number"], content["version"], content["about"]))
    return found


def latest(spark: SparkSession, folder: str) -> Commit | None:
    files = Files(spark, folder)
    for name in reversed(files.names(COMMITS)):
        try:
            content = json.loads(files.read(f"{COMMITS}/{name}"))
        except ValueError:
            continue
        return Commit(content["number"], content["version"], content["about"])
    return None


class Version:
    """A version being written; nobody sees it before ``commit``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self._files = Files(spark, self.folder)
        taken = [int(n.removesuffix(".json")) for n in self._files.names(COMMITS)]
        self.number = max(taken, default=0) + 1
        self.name = f"version-{self.number:08d}-{uuid.uuid4().hex}"

    @property
    def path(self) -> str:
        return f"{self.folder}/{self.name}"

    def make_folder(self, name: str) -> None:
        self._files.make_folder(f"{self.name}/{name}")

    def discard(self) -> None:
        self._files.remove(self.name)

    def commit(self, about: Mapping[str, Any]) -> Commit:
        """Makes this the current version, or raises and removes it if another was committed meanwhile."""
        content = {"number": self.number, "version": self.name, "about": dict(about)}
        if not self._files.claim(f"{COMMITS}/{self.number:08d}.json", json.dumps(content)):
            self.discard()
            raise OvertakenError(f"{self.folder}: version {self.number} was committed by another writer")
        return Commit(self.number, self.name, content["about"])


def sweep(spark: SparkSession, folder: str, keep: int = 1) -> list[str]:
    """Removes versions older than the last ``keep`` commits, and what writers left that died before that.

    A version with a number above the latest commit is someone's work and stays.
    """
    files, known = Files(spark, folder), commits(spark, folder)
    if not known:
        return []
    kept = {c.version for c in known[-keep:]}
    gone = [
        n for n in files.names()
        if n.startswith("version-") and n not in kept and int(n.split("-")[1]) <= known[-1].number
    ]
    for name in gone:
        files.remove(name)
    for c in known[:-keep]:
        files.remove(f"{COMMITS}/{c.number:08d}.json")
    return gone
