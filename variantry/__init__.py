"""Spark-native post-processing of annotated genomic variants."""

from variantry.config import PipelineConfig, Rule
from variantry.session import build_session

__all__ = ["PipelineConfig", "Rule", "build_session"]
