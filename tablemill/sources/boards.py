"""A data source that scans paged boards: ``spark.read.format("board")`` and ``spark.readStream.format("board")``.

A board answers GET with JSON {"total": n, "rows": [{...}]} for site, term, country, offset and limit
(limit 0 asks for the total only).  Sites and countries make lanes; a lane asks for its terms one after the other and
for one page at a time, so that a board never sees more than one request of a lane.

In batch a lane is a partition.  A lane that is told to wait (429 and the like) or fails three times in a row stops; what it
had stays, and the terms that failed or were not reached come as rows with ``scan_error``, so that no term is lost unseen.

In a stream the driver admits pages: the offset holds for each lane the term, the page, the errors in a row
and the terms given up, by the same rules.  It lives in the checkpoint, so a stream that goes on repeats no page; errors of
reading a page fail the batch, which Spark repeats from the same offset.

Options: ``url``; ``sites``, ``countries`` and ``terms`` (JSON lists); ``target`` (rows wanted of each lane, thrice oversampled,
over its terms; batch only), ``page`` (rows of a page), ``pages`` (pages of a lane in one micro-batch), ``hours_old``, ``pause`` (seconds
between requests), ``errors`` (in a row), ``tries`` and ``wait`` (of one request).
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StringType, StructType

from tablemill.sources import store, web

#: What a scan adds to a board's own columns.
SCAN = "site string, country string, search_term_used string, page_offset long, scraped_at string, scan_error string"
ROWS = "id string, title string, company string, job_url string, job_url_direct string, description string, location string, date_posted string, is_remote string, job_type string, job_level string, job_function string, company_industry string, company_url string"


@dataclass
class Lane(InputPartition):
    """A site's country with the pages to read: (term, first row, rows wanted; None: all), and the terms given up, with the reason."""

    site: str
    country: str
    pages: list[tuple[str, int, int | None]]
    lost: list[tuple[str, str]] = field(default_factory=list)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


class _Board:
    """The requests of one lane."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.url, self.hours = options["url"], options.get("hours_old")
        self.page, self.pause = int(options.get("page", 25)), float(options.get("pause", 0))
        self.errors = int(options.get("errors", store.MOST_ERRORS))
        self.patience = web.Patience(int(options.get("tries", 1)), float(options.get("wait", 2.0)))
        self.fields = schema.fields
        self._asked = False

    def ask(self, site: str, country: str, term: str, offset: int, limit: int) -> dict:
        if self._asked and self.pause:
            time.sleep(self.pause)
        self._asked = True
        url = web.query(self.url, site=site, country=country, term=term, offset=offset, limit=limit, hours_old=self.hours)
        return web.call("GET", url, patience=self.patience, again=tuple(s for s in web.PASSING if s != 429))

    def row(self, lane: Lane, term: str, offset: int | None, values: dict, error: str | None = None) -> tuple:
        own = {"site": lane.site, "country": lane.country, "search_term_used": term, "page_offset": offset, "scraped_at": _now(), "scan_error": error}

        def value(f):
            v = own[f.name] if f.name in own else values.get(f.name)
            if v is not None and isinstance(f.dataType, StringType) and not isinstance(v, str):
                v = json.dumps(v)
            return v

        return tuple(value(f) for f in self.fields)

    def rows(self, lane: Lane, term: str, first: int, wanted: int | None) -> Iterator[tuple]:
        """Pages of a term from ``first`` on, until it has no more or ``wanted`` rows are there."""
        offset, stop = first, None if wanted is None else first + wanted
        while stop is None or offset < stop:
            limit = self.page if stop is None else min(self.page, stop - offset)
            found = (self.ask(lane.site, lane.country, term, offset, limit) or {}).get("rows") or []
            for values in found:
                yield self.row(lane, term, offset, values)
            offset += len(found)
            if len(found) < limit:
                return


def _limited(error: Exception) -> bool:
    return store.looks_limited(error) or isinstance(error, web.Refused) and error.status == 429


class BoardSource(DataSource):
    """See the module; columns beyond those of a scan are the board's own, by name."""

    @classmethod
    def name(cls) -> str:
        return "board"

    def schema(self) -> str:
        return f"{SCAN}, {ROWS}"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _BatchReader(dict(self.options), schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options), schema)


def _lists(options: dict[str, str]) -> tuple[list[str], list[str], list[str]]:
    return tuple(list(dict.fromkeys(json.loads(options[k]))) for k in ("sites", "countries", "terms"))


class _BatchReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.schema = options, schema

    def partitions(self) -> list[Lane]:
        sites, countries, terms = _lists(self.options)
        target = self.options.get("target")
        wanted = store.per_term_quota(int(target), len(terms)) if target and terms else None
        return [Lane(s, c, [(t, 0, wanted) for t in terms]) for s in sites for c in countries] or [Lane("", "", [])]

    def read(self, lane: Lane) -> Iterator[tuple]:
        board, errors, stopped = _Board(self.options, self.schema), 0, None
        for term, first, wanted in lane.pages:
            if stopped:
                yield board.row(lane, term, None, {}, f"not scanned: {stopped}")
                continue
            try:
                yield from board.rows(lane, term, first, wanted)
                errors = 0
            except web.Refused as e:
                errors += 1
                yield board.row(lane, term, None, {}, str(e))
                if _limited(e):
                    stopped = "the board asked for a stop"
                elif errors >= board.errors:
                    stopped = f"{errors} errors in a row"


class _StreamReader(DataSourceStreamReader):
    """Offsets: {lane: {term: its number, page, errors, lost: [number, reason] of the terms given up}}, lanes named "site|country"."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.schema = options, schema
        self.sites, self.countries, self.terms = _lists(options)
        self.pages = int(options.get("pages", 4))
        self._now: dict | None = None

    def initialOffset(self) -> dict:
        return {f"{s}|{c}": {"term": 0, "page": 0, "errors": 0, "lost": []} for s in self.sites for c in self.countries}

    def _advance(self, lane: str, at: dict, board: _Board) -> dict:
        """Where the lane gets to with the next few pages, by the totals that the board tells."""
        site, country = lane.split("|", 1)
        at, left = {**at, "lost": list(at["lost"])}, self.pages
        while left and at["term"] < len(self.terms):
            k = at["term"]
            try:
                total = board.ask(site, country, self.terms[k], 0, 0)["total"]
                at["errors"] = 0
            except web.Refused as e:
                at["errors"] += 1
                at["lost"].append([k, str(e)])
                at |= {"term": k + 1, "page": 0}
                if _limited(e) or at["errors"] >= board.errors:
                    at["lost"] += [[n, "not scanned: the lane has stopped"] for n in range(k + 1, len(self.terms))]
                    at["term"] = len(self.terms)
                continue
            pages = -(-total // board.page)
            step = min(left, max(0, pages - at["page"]))
            at["page"] += step
            left -= step
            if at["page"] >= pages:
                at |= {"term": at["term"] + 1, "page": 0}
        return at

    def latestOffset(self) -> dict:
        if self._now is None:
            return self.initialOffset()
        board = _Board(self.options, self.schema)
        return {lane: self._advance(lane, at, board) for lane, at in self._now.items()}

    def partitions(self, start: dict, end: dict) -> list[Lane]:
        self._now = end
        out, size = [], int(self.options.get("page", 25))
        for lane, to in end.items():
            site, country = lane.split("|", 1)
            at = start.get(lane) or {"term": 0, "page": 0, "lost": []}
            lost = {k: why for k, why in to["lost"][len(at["lost"]) :]}
            pages: list[tuple[str, int, int | None]] = []
            for k in range(at["term"], min(to["term"] + 1, len(self.terms))):
                first = at["page"] if k == at["term"] else 0
                if k in lost:
                    continue
                if k < to["term"]:
                    pages.append((self.terms[k], first * size, None))
                elif to["page"] > first:
                    pages.append((self.terms[k], first * size, (to["page"] - first) * size))
            if pages or lost:
                out.append(Lane(site, country, pages, [(self.terms[k], why) for k, why in lost.items()]))
        return out or [Lane("", "", [])]

    def read(self, lane: Lane) -> Iterator[tuple]:
        board = _Board(self.options, self.schema)
        for term, first, wanted in lane.pages:
            yield from board.rows(lane, term, first, wanted)
        for term, why in lane.lost:
            yield board.row(lane, term, None, {}, why)

    def commit(self, end: dict) -> None:
        self._now = end


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BoardSource)


def failures(scan: DataFrame) -> DataFrame:
    """site, country, search_term_used, scan_error of the terms that failed or were not reached."""
    return scan.filter("scan_error is not null").select("site", "country", "search_term_used", "scan_error")


def postings(scan: DataFrame) -> DataFrame:
    """The rows of a scan under the names that ``plans.jobs`` collects; failures are left out."""
    names = {
        "platform": "site", "source_id": "id", "actual_role": "title", "company_name": "company", "job_description": "description", "posted_date": "date_posted", "search_term": "search_term_used",
    }
    same = ["country", "location", "is_remote", "job_type", "job_level", "job_function", "company_industry", "company_url", "scraped_at"]
    url = F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in ("job_url", "job_url_direct")))
    return scan.filter("scan_error is null").select(*(F.col(b).alias(a) for a, b in names.items()), *same, url.alias("url"), F.lit(None).cast("string").alias("job_id"))
