"""Bounded downloads from listed hosts; for drivers and connectors, not for plans."""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable


class Refused(ValueError):
    """A URL or answer that the rules don't allow."""


def allowed(url: str, hosts: set[str]) -> str:
    """The URL without fragment if it is https on a listed host, without user, other port or credentials in its query."""
    u = urllib.parse.urlsplit(url)
    secret = any(k in u.query.lower() for k in ("apikey", "token", "authorization"))
    if u.scheme != "https" or u.hostname not in hosts or u.username or u.password or u.port not in (None, 443) or secret:
        raise Refused("the URL is not allowed")
    return urllib.parse.urldefrag(url)[0]


class SameHosts(urllib.request.HTTPRedirectHandler):
    """Follows a redirect only if its target is allowed; what isn't is never asked for."""

    def __init__(self, hosts: set[str]):
        self.hosts = hosts

    def redirect_request(self, req, fp, code, msg, headers, newurl):
        return super().redirect_request(req, fp, code, msg, headers, allowed(newurl, self.hosts))


def download(url: str, hosts: set[str], *, limit: int = 50 << 20, attempts: int = 4, fetch: Callable | None = None, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """The content at url, at most `limit` bytes; each redirect must stay on the hosts; passing faults are tried again later."""
    fetch = fetch or (lambda u: urllib.request.build_opener(SameHosts(hosts)).open(u, timeout=60))
    url = allowed(url, hosts)
    for n in range(attempts):
        try:
            with fetch(url) as answer:
                allowed(answer.geturl(), hosts)
                content = answer.read(limit + 1)
            if len(content) > limit:
                raise Refused("the answer is too large")
            return content
        except urllib.error.HTTPError as e:
            if n + 1 == attempts or not (e.code in (408, 425, 429) or e.code >= 500):
                raise
        except (urllib.error.URLError, TimeoutError):
            if n + 1 == attempts:
                raise
        sleep(2.0**n)
    raise AssertionError("unreachable")
