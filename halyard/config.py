"""Settings by profile from a TOML file; ${NAME} stands for an environment variable and @path for a file's first line.

A profile's tables are laid over those of the profile it inherits from, `default` in the end. Logged settings
have their secrets replaced."""

from __future__ import annotations

import logging
import os
import re
import tomllib
from pathlib import Path

log = logging.getLogger("halyard")
SECRET = re.compile(r"token|secret|key|password|connection", re.IGNORECASE)


def _over(base: dict, top: dict) -> dict:
    return base | {k: _over(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in top.items()}


def _filled(x, env):
    if isinstance(x, dict):
        return {k: _filled(v, env) for k, v in x.items()}
    if isinstance(x, list):
        return [_filled(v, env) for v in x]
    if isinstance(x, str) and x.startswith("@"):
        return Path(x[1:]).read_text().splitlines()[0]
    return re.sub(r"\$\{(\w+)\}", lambda m: env.get(m[1], ""), x) if isinstance(x, str) else x


def redacted(x, name: str = ""):
    if isinstance(x, dict):
        return {k: redacted(v, k) for k, v in x.items()}
    return "***" if x and SECRET.search(name) and not isinstance(x, bool) else x


def read_config(path: str | Path | None = None, profile: str | None = None, env=None) -> dict:
    """The settings of a profile, by default the one that HALYARD_PROFILE names."""
    env = os.environ if env is None else env
    profile = profile or env.get("HALYARD_PROFILE", "default")
    every = tomllib.loads(Path(path or Path(__file__).parent / "conf.toml").read_text())
    if profile not in every:
        raise ValueError(f"no profile {profile!r}; there are: {', '.join(every)}")
    chain, at = [], profile
    while at and at not in chain:
        chain.append(at)
        at = every[at].get("inherits", "default" if at != "default" else None)
        if at and at not in every:
            raise ValueError(f"profile {chain[-1]!r} inherits from {at!r}, which is not there")
    out: dict = {}
    for one in reversed(chain):
        out = _over(out, {k: v for k, v in every[one].items() if k != "inherits"})
    out = _filled(out, env)
    log.info("Using profile %s", profile)
    log.debug("Settings: %s", redacted(out))
    return out
