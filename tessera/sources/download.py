"""The dump's files over HTTP. The transport is a parameter, so nothing here needs a network to be tested."""

from __future__ import annotations

import logging
import re
import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date
from html.parser import HTMLParser
from pathlib import Path
from typing import Protocol
from urllib.parse import urljoin

from pyspark.sql import Column

from .archives import is_zip

log = logging.getLogger(__name__)

#: Kinds of file and the patterns of their names.
KINDS = {
    "emp": r"Empresas\d+\.zip", "estab": r"Estabelecimentos\d+\.zip", "cnae": r"Cnaes\.zip", "natureza": r"Naturezas\.zip", "municipio": r"Municipios\.zip",
    "pais": r"Paises\.zip", "quals": r"Qualificacoes\.zip", "motivos": r"Motivos\.zip", "simples": r"Simples\.zip", "socios": r"Socios\d+\.zip",
}
FOLDER = "/arquivos/"


@dataclass
class Response:
    status: int
    body: bytes = b""
    blocks: Iterable[bytes] | None = None

    def stream(self) -> Iterator[bytes]:
        return iter(self.blocks if self.blocks is not None else [self.body])


class Transport(Protocol):
    def __call__(self, url: str, headers: Mapping[str, str]) -> Response: ...


def urllib_transport(url: str, headers: Mapping[str, str]) -> Response:
    """The standard library's client."""
    import urllib.error
    import urllib.request

    try:
        got = urllib.request.urlopen(urllib.request.Request(url, headers=dict(headers)), timeout=120)
    except urllib.error.HTTPError as e:
        return Response(e.code)
    return Response(got.status, blocks=iter(lambda: got.read(1 << 20), b""))


class _Anchors(HTMLParser):
    """The targets of a page's links, in order."""

    def __init__(self) -> None:
        super().__init__()
        self.targets: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.targets += [value for name, value in attrs if tag == "a" and name == "href" and value]


def links(get: Transport, url: str) -> list[str]:
    """What an index page links to."""
    page = get(url, {})
    if page.status != 200:
        raise OSError(f"HTTP {page.status}: {url}")
    reader = _Anchors()
    reader.feed(b"".join(page.stream()).decode("utf-8", "replace"))
    return reader.targets


def _date(folder: str) -> date | None:
    try:
        return date.fromisoformat(folder.removesuffix("/")) if len(folder) == 11 and folder.endswith("/") else None
    except ValueError:
        return None


def latest_dump(get: Transport, base: str) -> str:
    """The latest date that a folder of the index page is named after."""
    newest = max(filter(None, map(_date, links(get, base + FOLDER))), default=None)
    if newest is None:
        raise OSError("the index has no dated folders")
    return newest.isoformat()


def list_files(get: Transport, base: str, day: str) -> list[dict[str, str]]:
    """Names and addresses of the zip files that stand in a dump's own folder."""
    folder = f"{base}{FOLDER}{day}/"
    return [{"name": target, "url": urljoin(folder, target)} for target in links(get, folder) if target.endswith(".zip") and not set(target) & set("?/")]


def kind_pattern(kinds: Iterable[str]) -> str:
    return "(?i)" + "|".join(f"({KINDS[k]})" for k in kinds)


def of_kinds(files: list[dict[str, str]], kinds: Iterable[str]) -> list[dict[str, str]]:
    pattern = re.compile(kind_pattern(kinds))
    return [f for f in files if pattern.search(f["name"])]


def is_of_kinds(name: Column, kinds: Iterable[str]) -> Column:
    return name.rlike(kind_pattern(kinds))


@dataclass(frozen=True)
class Attempts:
    """How often something is tried, and how long to wait in between; what `final` names isn't tried again."""

    times: int = 3
    wait: float = 5.0
    sleep: Callable[[float], None] = time.sleep
    final: tuple[type[Exception], ...] = (FileNotFoundError,)

    def of(self, what: str, action: Callable[[], None]) -> None:
        failures = 0
        while True:
            try:
                return action()
            except self.final:
                raise
            except OSError as e:
                failures += 1
                if failures >= self.times:
                    raise
                log.warning("%s failed (%d of %d): %s", what, failures, self.times, e)
            self.sleep(self.wait)


@dataclass
class Target:
    """A file that is written from the beginning or, where its server agrees, from where it ends."""

    path: Path
    resume: bool = False

    def size(self) -> int:
        return self.path.stat().st_size if self.resume and self.path.exists() else 0

    def take(self, get: Transport, url: str) -> None:
        """One request. A range beyond the end (416) means that the file is whole."""
        size = self.size()
        answer = get(url, {"Range": f"bytes={size}-"} if size else {})
        match answer.status:
            case 416 if size:
                return
            case 404:
                raise FileNotFoundError(url)
            case 200 | 206:
                with self.path.open("r+b" if size else "wb") as out:
                    out.seek(size if answer.status == 206 else 0)
                    out.truncate()
                    out.writelines(answer.stream())
            case other:
                raise OSError(f"HTTP {other}: {url}")


def fetch(get: Transport, url: str, to: Path, *, resume: bool = False, attempts: Attempts = Attempts()) -> Path:
    """Download to `to`. With `resume`, what is there stays and the rest is asked for."""
    to.parent.mkdir(parents=True, exist_ok=True)
    attempts.of(url, lambda: Target(to, resume).take(get, url))
    return to


@dataclass
class Fetched:
    done: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)


def fetch_all(get: Transport, files: list[dict[str, str]], folder: Path, *, workers: int = 4, force: bool = False, dry_run: bool = False, **options) -> Fetched:
    """Fetch files side by side; valid zips that are there are skipped, 404 is noted, and what
    fails or isn't a zip afterwards is listed."""
    out = Fetched()

    def one(f: dict[str, str]) -> tuple[str, str]:
        to = folder / f["name"]
        if not force and is_zip(to):
            return "skipped", f["name"]
        if dry_run:
            return "done", f["name"]
        try:
            fetch(get, f["url"], to, **options)
        except FileNotFoundError:
            return "missing", f["name"]
        except OSError as e:
            log.error("%s: %s", f["name"], e)
            return "failed", f["name"]
        return ("done" if is_zip(to) else "failed"), f["name"]

    with ThreadPoolExecutor(workers) as pool:
        for kind, name in pool.map(one, files):
            getattr(out, kind).append(name)
    return out
