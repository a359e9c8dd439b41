"""Settings of a run, and the driver's log."""

from __future__ import annotations

import logging
import sys
from collections.abc import Mapping
from logging.handlers import RotatingFileHandler

#: What holds where neither a file nor the command line says otherwise.
DEFAULTS = {"MeterPerPixel": "0.16", "OutputFormat": "png"}
DEVICES = ("cuda", "cpu")
_LOWERED = {logging.CRITICAL: logging.ERROR, logging.ERROR: logging.WARNING, logging.WARNING: logging.INFO, logging.INFO: logging.DEBUG}


def merged(given: Mapping[str, object], command_line: Mapping[str, object]) -> dict[str, str]:
    """Settings from a file, overridden by what the command line sets, over the defaults; the format in lower case."""
    out = DEFAULTS | {k: str(v) for k, v in given.items() if v not in (None, "")} | {k: str(v) for k, v in command_line.items() if v not in (None, "")}
    return out | {"OutputFormat": out["OutputFormat"].lower()}


def checked(settings: Mapping[str, str]) -> dict[str, str]:
    """Settings that can be run: both folders are required, and a device that is missing or unknown becomes the first known one."""
    if not settings.get("InputDir") or not settings.get("OutputDir"):
        raise ValueError("InputDir and OutputDir must be given")
    return {**settings, "Device": settings["Device"] if settings.get("Device") in DEVICES else DEVICES[0]}


class _OneLower(logging.Filter):
    """Records of other loggers count one level less; a handler asks again whether they reach its own."""

    def __init__(self, own: str, handler: logging.Handler) -> None:
        super().__init__()
        self.own, self.handler = own, handler

    def filter(self, record: logging.LogRecord) -> bool:
        if not record.name.startswith(self.own) and record.levelno in _LOWERED and not getattr(record, "lowered", False):
            record.levelno, record.lowered = _LOWERED[record.levelno], True
            record.levelname = logging.getLevelName(record.levelno)
        return record.levelno >= self.handler.level


def set_up_log(level: str = "INFO", path: str | None = None, own: str = "quoin") -> logging.Logger:
    """The console from `level` up, and a file of all records that begins anew at 10 MB."""
    root = logging.getLogger()
    for h in list(root.handlers):
        root.removeHandler(h)
    root.setLevel(logging.DEBUG)
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stderr)]
    handlers[0].setLevel(level.upper())
    if path:
        handlers.append(RotatingFileHandler(path, maxBytes=10_000_000, backupCount=5))
        handlers[1].setLevel(logging.DEBUG)
    for h in handlers:
        h.addFilter(_OneLower(own, h))
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
        root.addHandler(h)
    return logging.getLogger(own)
