"""Endpoint routing by app id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lifeline.config import SyncConfig


def _pick(app_id: Column, cfg: SyncConfig, value) -> Column:
    out = None
    for r in cfg.routes[:-1]:
        cond = app_id.contains(r.match)
        out = F.when(cond, value(r)) if out is None else out.when(cond, value(r))
    default = value(cfg.routes[-1])
    return default if out is None else out.otherwise(default)


def route_columns(app_id: Column, cfg: SyncConfig) -> dict[str, Column]:
    """Route name, secret name, endpoint (URL without the secret) and full
    URL; first matching route wins.

    A null app id yields null URL parts (``concat`` propagates null), as in
    the SQL it replaces; the jobs always default the app id first.
    """
    endpoint = _pick(
        app_id,
        cfg,
        lambda r: F.concat(F.lit(f"{cfg.endpoint_base}?{r.id_param}="), app_id),
    )
    secret = _pick(app_id, cfg, lambda r: F.lit(r.secret_name))
    return {
        "route": _pick(app_id, cfg, lambda r: F.lit(r.name)),
        "app_secret": secret,
        "endpoint": endpoint,
        "mp_url": F.concat(endpoint, F.lit("&api_secret="), secret),
    }


def is_mobile_endpoint(endpoint: Column) -> Column:
    """Mobile payloads name the client id ``app_instance_id``.  Decided on
    the endpoint text without the secret, so a secret can never flip it."""
    return endpoint.contains("ios") | endpoint.contains("android")
