"""Requests that know when to wait and when to give up."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from dataclasses import dataclass

#: Answers that may be other ones a moment later.
PASSING = (429, 500, 502, 503, 504)


class Refused(Exception):
    """An answer that is none; ``status`` tells which (0: no answer at all)."""

    def __init__(self, status: int, said: str):
        super().__init__(f"{status}: {said[:200]}")
        self.status = status


@dataclass(frozen=True)
class Patience:
    """How often to try, and how long to wait at first; the wait doubles each time."""

    tries: int = 5
    wait: float = 2.0
    timeout: float = 30.0


def call(method: str, url: str, body=None, headers: dict[str, str] | None = None, patience: Patience = Patience(), again: tuple[int, ...] = PASSING):
    """The JSON answer (None if empty) of a request, which is repeated on answers in ``again`` and when none comes."""
    data = None if body is None else json.dumps(body, default=str).encode()
    for attempt in range(patience.tries):
        request = urllib.request.Request(url, data, {"Content-Type": "application/json", **(headers or {})}, method=method)
        try:
            with urllib.request.urlopen(request, timeout=patience.timeout) as answer:
                said = answer.read()
                return json.loads(said) if said.strip() else None
        except urllib.error.HTTPError as e:
            problem = Refused(e.code, e.read().decode(errors="replace"))
        except (urllib.error.URLError, OSError) as e:
            problem = Refused(0, str(e))
        if attempt == patience.tries - 1 or (problem.status and problem.status not in again):
            raise problem
        time.sleep(patience.wait * 2**attempt)
    raise ValueError("a request needs at least one try")


def query(url: str, **parameters) -> str:
    return f"{url}?{urllib.parse.urlencode({k: v for k, v in parameters.items() if v is not None})}"
