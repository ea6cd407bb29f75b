"""Writing registers, features, summaries, and publishing a run as a whole."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import time
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.operators.schema import month_ok

#: What a run publishes, by template of the city's name.
PUBLISHED = ("{city}_Match_Register", "{city}_Defaulters", "{city}_Defaulters_Set1", "{city}_Defaulters.geojson", "{city}_Summary.json", "{city}_Geocoded", "{city}_Change")


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Values as they stand, blanks around them included.  One file only on demand: it puts all rows through one task."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def feature(geometry: Column, properties: Sequence[str]) -> Column:
    """One GeoJSON feature as text; properties are text, a null geometry stays null."""
    props = F.struct(*[F.coalesce(F.col(p).cast("string"), F.lit("")).alias(p) for p in properties])
    head = F.concat(F.lit('{"type":"Feature","geometry":'), F.coalesce(geometry, F.lit("null")), F.lit(',"properties":'), F.to_json(props), F.lit("}"))
    return head


def polygon_json(rings: Column) -> Column:
    """A polygon's GeoJSON; rings are closed."""
    ring = lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), lambda p: F.array(p["x"], p["y"]))
    return F.when(rings.isNotNull(), F.to_json(F.struct(F.lit("Polygon").alias("type"), F.transform(rings, ring).alias("coordinates"))))


def write_features(df: DataFrame, path: str, geometry: Column, properties: Sequence[str], order: str = "row_idx") -> None:
    """Features as lines, in order, over as many files as the rows need; ``collection`` joins them where one document is wanted."""
    df.select(F.col(order), feature(geometry, properties).alias("value")).orderBy(order).select("value").write.mode("overwrite").text(path)


def collection(lines: Sequence[str], run_id: str, month: str, version: str = "1.0") -> str:
    head = json.dumps({"type": "FeatureCollection", "schema_version": version, "run_id": run_id, "month": month})[:-1]
    return f'{head}, "features": [{",".join(lines)}]}}'


def write_summary(summary: DataFrame, path: str) -> None:
    """A summary is one row."""
    atomic_write(Path(path), json.dumps(json.loads(summary.toJSON().first()), indent=2, sort_keys=True))


def atomic_write(path: Path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    passing = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    with passing.open("w") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    passing.replace(path)


def file_hash(path: Path, block: int = 1 << 20) -> str:
    h = hashlib.sha256()
    with path.open("rb") as f:
        while part := f.read(block):
            h.update(part)
    return h.hexdigest()


def hashes(df_paths: DataFrame) -> DataFrame:
    """sha256 of the files of a ``binaryFile`` frame, by Spark."""
    return df_paths.select("path", F.sha2("content", 256).alias("sha256"))


class Registry:
    """Run records as JSON files; a record in a terminal state changes on repair alone."""

    FINAL = ("SUCCEEDED", "FAILED")

    def __init__(self, folder: str | Path) -> None:
        self.folder = Path(folder)

    def _path(self, run_id: str) -> Path:
        if not run_id.isalnum():
            raise ValueError(f"not a run id: {run_id!r}")
        return self.folder / f"{run_id}.json"

    @contextmanager
    def _locked(self, run_id: str, wait_s: float = 10.0, stale_s: float = 30.0):
        lock = self._path(run_id).with_suffix(".lock")
        lock.parent.mkdir(parents=True, exist_ok=True)
        until = time.monotonic() + wait_s
        while True:
            try:
                os.close(os.open(lock, os.O_CREAT | os.O_EXCL))
                break
            except FileExistsError:
                try:
                    if time.time() - lock.stat().st_mtime > stale_s:
                        lock.unlink(missing_ok=True)
                        continue
                except FileNotFoundError:
                    continue
                if time.monotonic() > until:
                    raise TimeoutError(f"{lock} is held") from None
                time.sleep(0.02)
        try:
            yield
        finally:
            lock.unlink(missing_ok=True)

    def create(self, city: str, month: str, **more) -> dict:
        if not month_ok(month):
            raise ValueError(f"not a month: {month!r}")
        record = {"run_id": uuid.uuid4().hex[:12], "city": city, "month": month, "status": "QUEUED", "created_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())} | more
        atomic_write(self._path(record["run_id"]), json.dumps(record))
        return record

    def load(self, run_id: str) -> dict:
        return json.loads(self._path(run_id).read_text())

    def update(self, run_id: str, repair: bool = False, **changes) -> dict:
        with self._locked(run_id):
            record = self.load(run_id)
            if record["status"] in self.FINAL and not repair and changes.get("status", record["status"]) != record["status"]:
                raise ValueError(f"{run_id} has ended as {record['status']}")
            record |= changes
            atomic_write(self._path(run_id), json.dumps(record))
        return record

    def records(self, city: str | None = None, status: str | None = None) -> list[dict]:
        """Newest first."""
        rows = [json.loads(p.read_text()) for p in self.folder.glob("*.json")] if self.folder.exists() else []
        rows = [r for r in rows if (city is None or r["city"].casefold() == city.casefold()) and (status is None or r["status"] == status)]
        return sorted(rows, key=lambda r: (r["created_at"], r["run_id"]), reverse=True)


@contextmanager
def city_lock(folder: str | Path, city: str, run_id: str):
    """One run a city; the lock of a dead process is taken over."""
    path = Path(folder) / f"{city.casefold()}.lock"
    path.parent.mkdir(parents=True, exist_ok=True)
    for _ in range(2):
        try:
            handle = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            break
        except FileExistsError:
            held = json.loads(path.read_text() or "{}")
            if held.get("pid") and not alive(held["pid"]):
                path.unlink(missing_ok=True)
                continue
            raise RuntimeError(f"{city} is locked by run {held.get('run_id')}") from None
    else:
        raise RuntimeError(f"{city} is locked")
    with os.fdopen(handle, "w") as f:
        json.dump({"pid": os.getpid(), "run_id": run_id}, f)
    try:
        yield
    finally:
        path.unlink(missing_ok=True)


def alive(pid: int) -> bool:
    try:
        os.kill(pid, 0)
    except ProcessLookupError:
        return False
    except PermissionError:
        return True
    return True


def publish(stage: str | Path, root: str | Path, city: str, month: str, run_id: str, details: dict | None = None) -> dict:
    """Moves a staged folder to its immutable place, writes its manifest once and then points ``latest`` at it."""
    home = Path(root) / city / month / run_id
    manifest_path = home.with_suffix(".manifest.json")
    if manifest_path.exists():
        raise FileExistsError(f"{run_id} is published")
    home.parent.mkdir(parents=True, exist_ok=True)
    if Path(stage).resolve() != home.resolve():
        shutil.move(str(stage), home)
    files = {str(p.relative_to(home)): file_hash(p) for p in sorted(home.rglob("*")) if p.is_file() and not p.name.startswith(".")}
    manifest = {"run_id": run_id, "city": city, "month": month, "schema_version": "1.0", "outputs": files} | (details or {})
    passing = manifest_path.with_name(f".{uuid.uuid4().hex}")
    atomic_write(passing, json.dumps(manifest, indent=2))
    try:
        os.link(passing, manifest_path)  # fails if it is there already
    finally:
        passing.unlink()
    atomic_write(Path(root) / city / "latest.json", json.dumps({"run_id": run_id, "month": month, "path": str(home)}))
    return manifest


def verify(root: str | Path, city: str, month: str, run_id: str) -> bool:
    """Whether the published files still are what the manifest says."""
    home = Path(root) / city / month / run_id
    manifest = json.loads(home.with_suffix(".manifest.json").read_text())
    return all((home / n).exists() and file_hash(home / n) == h for n, h in manifest["outputs"].items())
