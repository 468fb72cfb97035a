from . import catalog, contracts, io, marts, pipelines, quality, streams, transforms
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "catalog", "contracts", "io", "marts", "pipelines", "quality", "streams", "transforms"]
