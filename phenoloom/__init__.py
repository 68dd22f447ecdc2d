"""phenoloom: phenotype and association analytics for biobanks as Spark plans."""

from phenoloom.model import MatrixFrame, PHENO_KEY
from phenoloom.session import build_session, stage

__all__ = ["MatrixFrame", "PHENO_KEY", "build_session", "stage"]
