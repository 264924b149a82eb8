"""Statistical models: scoring expressions and Spark-driven fitters."""

from .bgnbd import BgNbdParams  # noqa: F401
from .cox import CoxParams  # noqa: F401
from .gamma_gamma import GammaGammaParams  # noqa: F401
