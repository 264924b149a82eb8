"""Model bundle passed to the scoring plans (any member may be missing:
missing models use the documented no-model fallbacks)."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from .. import config as C
from ..models import BgNbdParams, CoxParams, GammaGammaParams


@dataclass
class ModelBundle:
    cox: CoxParams | None = None
    cox_by_channel: dict = field(default_factory=dict)
    bgnbd: BgNbdParams | None = None
    gamma_gamma: GammaGammaParams | None = None
    config: dict = field(default_factory=dict)     # snapshot_date, xdays, penalizer of the training


# FIXED VALUES for the oracle-checked queries: parameters in the region the
# test visits settle in (BG/NBD with a small penalizer; Gamma-Gamma with the
# test data's mean spend; Cox with a small spend effect).
FIXED_BGNBD = BgNbdParams(r=2.71, alpha=255.4, a=1.355, b=2.351)
FIXED_GAMMA_GAMMA = GammaGammaParams(p=2.0, q=4.0, v=375000.0)
FIXED_COX_BASELINE = ((30.0, 0.1), (90.0, 0.3), (180.0, 0.5), (365.0, 0.8), (730.0, 1.2))
FIXED_COX = CoxParams(features=("avg_spend",), coef=(1e-6,), mean=(250000.0,),
                      baseline=FIXED_COX_BASELINE)


def fixed_models(per_channel: bool = False) -> ModelBundle:
    # every channel group has parameters of its own, so a mix-up shows
    chans = {g: replace(FIXED_COX, coef=(1e-6 * (i + 1),), baseline=tuple((t, h * (1 + 0.1 * i)) for t, h in FIXED_COX_BASELINE))
             for i, g in enumerate(C.CHANNEL_GROUP_NAMES)} if per_channel else {}
    return ModelBundle(cox=FIXED_COX, cox_by_channel=chans, bgnbd=FIXED_BGNBD,
                       gamma_gamma=FIXED_GAMMA_GAMMA)
