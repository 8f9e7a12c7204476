"""Configuration: exchanges between two databases, with rules for real-time and stored collections."""

from __future__ import annotations

import json
import logging
import os
import signal
import threading
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from pathlib import Path

log = logging.getLogger(__name__)

#: Defaults: milliseconds, bytes and numbers.
RT_MIN_DELAY, RT_DELAY, RT_EXPIRES, RT_BATCH = 99, 100, 5000, 161_000
ST_MIN_DELAY, ST_DELAY, ST_BATCH = 999, 2000, 256_000
DB, CO_WRITE, QUEUE, SMALL_BATCH = "IonM", 3, 4096, 16_000


@dataclass
class DataSync:
    """A rule: delays and expiry in milliseconds, batch in bytes, patterns of names left out."""

    min_delay: int = 0
    delay: int = 0
    batch: int = 0
    expires: int = 0
    queue: int = 0
    exclude: list[str] = field(default_factory=list)


@dataclass
class Exchange:
    sender_uri: str = ""
    sender_db: str = ""
    receiver_uri: str = ""
    receiver_db: str = ""
    realtime: dict[str, DataSync] = field(default_factory=dict)
    stored: dict[str, DataSync] = field(default_factory=dict)
    co_write: int = 0
    queue: int = 0


def normalise(e: Exchange, number: int = 0) -> Exchange:
    """e with defaults filled in and delays put in order; raises ValueError without addresses."""
    if not e.sender_uri or not e.receiver_uri:
        raise ValueError(f"exchange {number}: sender and receiver need an address")
    e.sender_db, e.receiver_db = e.sender_db or DB, e.receiver_db or DB
    e.co_write = max(2, e.co_write or CO_WRITE)
    e.queue = e.queue or QUEUE
    for name, r in e.realtime.items():
        r.min_delay, r.delay, r.expires, r.batch, r.queue = r.min_delay or RT_MIN_DELAY, r.delay or RT_DELAY, r.expires or RT_EXPIRES, r.batch or RT_BATCH, r.queue or e.queue
        latest = r.expires - 50
        r.min_delay = latest if r.min_delay >= r.expires else r.min_delay
        r.delay = max(latest if r.delay >= r.expires else r.delay, r.min_delay)
        _warn(name, r)
    for name, r in e.stored.items():
        r.min_delay, r.batch = r.min_delay or ST_MIN_DELAY, r.batch or ST_BATCH
        r.delay = max(r.delay or ST_DELAY, r.min_delay)
        _warn(name, r)
    return e


def _warn(name: str, r: DataSync) -> None:
    if r.batch < SMALL_BATCH:
        log.warning("rule %s: a batch of %d bytes is small", name, r.batch)


#: Other spellings of keys, lower case without signs.
_ALIASES = {"rt": "realtime", "st": "stored", "realtime": "realtime", "stored": "stored", "senderuri": "sender_uri", "senderdb": "sender_db", "receiveruri": "receiver_uri", "receiverdb": "receiver_db", "cowrite": "co_write", "mindelay": "min_delay"}


def _known(d: dict) -> dict:
    return {_ALIASES.get(k.lower().replace("_", "").replace("-", ""), k.lower()): v for k, v in d.items()}


def from_dict(data: dict) -> list[Exchange]:
    """Exchanges out of a parsed file; keys in any case, each list normalised."""
    out = []
    for k, raw in enumerate(_known(data).get("exchanges") or []):
        x = _known(raw)
        for part in ("realtime", "stored"):
            x[part] = {name: DataSync(**{n: v if n != "exclude" else ([v] if isinstance(v, str) else list(v or [])) for n, v in _known(rule or {}).items()}) for name, rule in (x.get(part) or {}).items()}
        out.append(normalise(Exchange(**x), k))
    return out


def parse(text: str) -> dict:
    """JSON, or YAML of nested keys, scalars and lists (by the yaml library where it is installed)."""
    try:
        return json.loads(text)
    except ValueError:
        pass
    try:
        import yaml
    except ImportError:
        return _plain_yaml(text)
    return yaml.safe_load(text)


def _plain_yaml(text: str) -> dict:
    lines = [(len(s) - len(s.lstrip()), s.strip()) for s in (x.split(" #")[0].rstrip() for x in text.splitlines()) if s.strip() and not s.strip().startswith("#") and s.strip() != "---"]

    def scalar(s: str):
        s = s.strip()
        if s[:1] in "\"'" and s[-1:] == s[:1]:
            return s[1:-1]
        if s.startswith("["):
            return [scalar(x) for x in s.strip("[]").split(",") if x.strip()]
        return int(s) if s.lstrip("-").isdigit() else None if s in ("", "null", "~") else s

    def block(k: int, indent: int):
        out = [] if lines[k][1].startswith("-") else {}
        while k < len(lines) and lines[k][0] == indent and lines[k][1].startswith("-") == isinstance(out, list):
            text_ = lines[k][1]
            if isinstance(out, list):
                rest = text_[1:].strip()
                if ":" in rest and rest[:1] not in "\"'":
                    inner = indent + len(text_) - len(rest)
                    lines[k] = (inner, rest)
                    value, k = block(k, inner)
                else:
                    value, k = scalar(rest), k + 1
                out.append(value)
            else:
                name, _, rest = text_.partition(":") if text_[:1] not in "\"'" else (text_[1 : text_.index(text_[0], 1)], ":", text_[text_.index(text_[0], 1) + 1 :].lstrip(" :"))
                if rest.strip():
                    out[name.strip()], k = scalar(rest), k + 1
                elif k + 1 < len(lines) and (lines[k + 1][0] > indent or lines[k + 1][0] == indent and lines[k + 1][1].startswith("-")):
                    out[name.strip()], k = block(k + 1, lines[k + 1][0])
                else:
                    out[name.strip()], k = None, k + 1
        return out, k

    return block(0, lines[0][0])[0] if lines else {}


def read_config(path: str) -> list[Exchange]:
    return from_dict(parse(Path(path).read_text()))


def dump(exchanges: list[Exchange], kind: str = "yaml") -> str:
    """Text that read_config loads to the same exchanges."""
    data = {"exchanges": [asdict(e) for e in exchanges]}
    if kind == "json":
        return json.dumps(data, indent=2)

    def lines(x, indent: int) -> list[str]:
        out = []
        for name, v in x.items():
            key = " " * indent + json.dumps(name) + ":"
            if isinstance(v, dict):
                out += [key, *lines(v, indent + 2)] if v else []
            elif isinstance(v, list):
                out += [f"{key} [{', '.join(json.dumps(i) for i in v)}]"] if v else []
            else:
                out.append(f"{key} {json.dumps(v)}")
        return out

    text = ["exchanges:"]
    for e in data["exchanges"]:
        body = lines(e, 4)
        text += ["  - " + body[0].strip(), *body[1:]]
    return "\n".join(text) + "\n"


def watch(path: str, on_change: Callable[[list[Exchange]], None], stop: threading.Event, poll_ms: int = 50, settle_ms: int = 5, signals: bool = False) -> None:
    """Calls on_change with the configuration at once and after each change of the file, until stop is set.

    Changes count when the file has been still for settle_ms. With signals a hang-up reads it again and an interrupt stops
    (main thread only). A file that can't be read leaves what was there.
    """
    again = threading.Event()
    if signals:
        signal.signal(signal.SIGHUP, lambda *_: again.set())
        signal.signal(signal.SIGINT, lambda *_: stop.set())
    seen = None
    while not stop.is_set():
        try:
            s = os.stat(path)
            now = (s.st_mtime_ns, s.st_size)
        except OSError:
            now = seen
        if now != seen or again.is_set():
            if seen is not None and stop.wait(settle_ms / 1000):
                break
            again.clear()
            try:
                s = os.stat(path)
                seen = (s.st_mtime_ns, s.st_size)
                loaded = read_config(path)
            except (OSError, ValueError, TypeError) as e:
                log.error("configuration stays as it was: %s", e)
                seen = seen or now
            else:
                on_change(loaded)
        stop.wait(poll_ms / 1000)
