"""Where tables and documents are, and where configuration comes from."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.sql import SparkSession

from .store import Store


@dataclass(frozen=True)
class Layout:
    """Paths of one client below a root that the cluster shares.

    All but the bronze files are tables and documents of the client's store, which commits them together; where
    their folders are is up to the store.
    """

    root: str
    client: str
    platform: str = ""

    def store(self, spark: SparkSession) -> Store:
        return Store(spark, f"{self.root}/{self.client}")

    def bronze(self, name: str) -> str:
        return f"{self.root}/{self.client}/bronze/{self.platform}/{name}.json"

    def silver(self, name: str) -> str:
        return f"{self.root}/{self.client}/silver/{self.platform}/{name}"

    def combined(self, name: str) -> str:
        return f"{self.root}/{self.client}/silver/combined/{name}_combined"

    def gold(self, name: str) -> str:
        return f"{self.root}/{self.client}/gold/{name}"

    def audit(self, run_id: str, table: str) -> str:
        return f"{self.root}/{self.client}/audit/dedup/{run_id}/{table}"

    def catalog(self) -> str:
        return f"{self.root}/{self.client}/gold/catalog.json"


def read_document(spark: SparkSession, path: str) -> dict[str, Any]:
    """A JSON document through Spark's own file systems."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


class ConfigProvider(Protocol):
    """Rows of client settings: of files, of a service, or of anything else with these two methods."""

    def platform(self, client: str, platform: str) -> dict[str, Any]: ...
    def policy(self, client: str) -> dict[str, Any]: ...


@dataclass(frozen=True)
class FileConfig:
    """Client settings in JSON documents below ``root``."""

    spark: SparkSession
    root: str

    def platform(self, client: str, platform: str) -> dict[str, Any]:
        rows = read_document(self.spark, f"{self.root}/clients/{client}/{platform}.json")
        rows = rows if isinstance(rows, list) else [rows]
        if not rows:
            raise ValueError(f"No configuration of platform {platform} for client {client}")
        return rows[0]

    def policy(self, client: str) -> dict[str, Any]:
        found = read_document(self.spark, f"{self.root}/clients/{client}/resolution_config.json")
        if not isinstance(found, dict):
            raise ValueError(f"Client {client} needs exactly one resolution document")
        return found


class ConfigError(RuntimeError):
    """A settings service that cannot be reached or says something else than settings."""


@dataclass(frozen=True)
class HttpConfig:
    """Client settings of a service that answers filters on its tables with JSON rows, as REST interfaces of
    databases do.

    Failures that may pass (no connection, 408, 429 and 5xx) are tried again after growing pauses; what a
    server asks to wait is waited. Other failures are raised at once. ``headers`` carry the key; it is in no message.
    """

    url: str
    headers: dict[str, str] = field(default_factory=dict, repr=False)
    platforms: str = "client_platforms_by_slug"
    policies: str = "client_configs_by_slug"
    timeout: float = 30.0
    attempts: int = 4
    pause: float = 0.5
    longest_pause: float = 30.0

    def rows(self, table: str, select: str, **filters: str) -> list[dict[str, Any]]:
        """The rows of a table whose columns equal the filters."""
        query = urllib.parse.urlencode({**{k: f"eq.{v}" for k, v in filters.items()}, "select": select})
        request = urllib.request.Request(f"{self.url.rstrip('/')}/{table}?{query}", headers={"Accept": "application/json", **self.headers})
        for attempt in range(1, self.attempts + 1):
            wait = min(self.longest_pause, self.pause * 2 ** (attempt - 1))
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                    found = json.loads(answer.read())
                break
            except urllib.error.HTTPError as e:
                if attempt == self.attempts or e.code not in (408, 429) and e.code < 500:
                    raise ConfigError(f"{table}: HTTP status {e.code} after {attempt} attempts") from None
                asked = e.headers.get("Retry-After", "")
                wait = min(self.longest_pause, float(asked)) if asked.isdigit() else wait
            except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
                if attempt == self.attempts:
                    raise ConfigError(f"{table}: no answer after {attempt} attempts ({type(e).__name__})") from None
            except ValueError:
                raise ConfigError(f"{table}: the answer is not JSON") from None
            time.sleep(wait)
        if not isinstance(found, list) or not all(isinstance(r, dict) for r in found):
            raise ConfigError(f"{table}: the answer is not a list of rows")
        return found

    def platform(self, client: str, platform: str) -> dict[str, Any]:
        """A client's settings of a platform: at least one row, of which the first counts."""
        rows = self.rows(self.platforms, "active,entities,overrides", client_slug=client, platform=platform)
        if not rows:
            raise LookupError(f"No configuration of platform {platform} for client {client}")
        return rows[0]

    def policy(self, client: str) -> dict[str, Any]:
        """A client's policy: exactly one row, with a whole document."""
        rows = self.rows(self.policies, "resolution_config", client_slug=client)
        if len(rows) != 1 or not isinstance(rows[0].get("resolution_config"), dict):
            raise ValueError(f"Client {client} needs exactly one resolution document")
        return rows[0]["resolution_config"]
