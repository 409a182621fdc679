"""Revenue-operations marts on Spark: conform, resolve, unify, enrich, classify, check."""

from revmart.config import Config

__all__ = ["Config"]
