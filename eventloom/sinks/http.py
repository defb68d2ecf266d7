"""An HTTP POST sender for :func:`eventloom.sinks.deliver`.

One POST per payload from the executor that holds the batch. The destination
overrides are added to the URL as ``?source=..&sourcetype=..&index=..`` (only the
non-empty ones, in that order); headers (for example an authorization token and
a channel id) are supplied by the caller and never enter a DataFrame. The
status text returned becomes the batch's receipt.
"""

from __future__ import annotations

import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable

from eventloom.operators.format import QUERY_STRING_ORDER

Opener = Callable[[urllib.request.Request, float], object]


def destination_url(url: str, destination: dict) -> str:
    """``url`` plus the non-empty destination overrides as a query string."""
    pairs = [(k, destination.get(k)) for k in QUERY_STRING_ORDER if destination.get(k)]
    if not pairs:
        return url
    sep = "&" if "?" in url else "?"
    return url + sep + urllib.parse.urlencode(pairs)


def http_post_sender(url: str, headers: dict[str, str] | None = None, timeout: float = 60.0,
                     opener: Opener | None = None) -> Callable[[str, dict], str]:
    """A ``send(payload, destination) -> status`` that POSTs the payload as UTF-8.

    A non-2xx answer is returned as its status text (``"503 Service Unavailable"``)
    rather than raised, so it lands in the receipt; connection errors raise, which
    fails the task and lets Spark retry it (delivery is at-least-once).
    """
    fixed = dict(headers or {})
    fixed.setdefault("Content-Type", "text/plain; charset=utf-8")
    do_open = opener or (lambda req, t: urllib.request.urlopen(req, timeout=t))  # noqa: S310

    def send(payload: str, destination: dict) -> str:
        req = urllib.request.Request(destination_url(url, destination), data=payload.encode("utf-8"),
                                     headers=fixed, method="POST")
        try:
            resp = do_open(req, timeout)
        except urllib.error.HTTPError as e:
            return f"{e.code} {e.reason}"
        with resp:
            return f"{resp.status} {resp.reason}"

    return send
