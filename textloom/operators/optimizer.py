"""Adam, with either kind of weight decay and with AMSGrad, as column arithmetic on a parameter table."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["param", "row", "col"]


@dataclass(frozen=True)
class AdamParams:
    """Hyperparameters; ``decay`` is ``("l2", rate)``, ``("decoupled", rate)`` or None."""

    lr: float = 1e-3
    beta_1: float = 0.9
    beta_2: float = 0.999
    eps: float = 1e-8
    decay: tuple[str, float] | None = None
    amsgrad: bool = False

    def __post_init__(self) -> None:
        if self.decay is not None and self.decay[0] not in ("l2", "decoupled"):
            raise ValueError(f"unknown decay {self.decay[0]!r}")


def change_params(current: AdamParams, new: AdamParams) -> AdamParams:
    """Replace the whole set. AMSGrad keeps an extra moment and stays as it was at the start."""
    if new.amsgrad != current.amsgrad:
        warnings.warn("AMSGrad is fixed for a run; the old setting is kept", stacklevel=2)
    return replace(new, amsgrad=current.amsgrad)


# From a step on: learning rate and betas, or a whole set.
Schedule = Mapping[int, "tuple[float, float, float] | AdamParams"]


def scheduled(hp: AdamParams, schedule: Schedule | None, step: int) -> AdamParams:
    """The hyperparameters of a step; steps count from 0."""
    new = (schedule or {}).get(step)
    if new is None:
        return hp
    if isinstance(new, AdamParams):
        return change_params(hp, new)
    lr, beta_1, beta_2 = new
    return replace(hp, lr=lr, beta_1=beta_1, beta_2=beta_2)


def init_state(params: DataFrame, hp: AdamParams) -> DataFrame:
    """Parameters with moments of zero."""
    moments = ["m", "v", *(["vmax"] if hp.amsgrad else [])]
    return params.select(*KEY, "theta", *[F.lit(0.0).alias(m) for m in moments])


def adam_step(state: DataFrame, grads: DataFrame, hp: AdamParams, t: int) -> DataFrame:
    """One update; ``t`` counts steps from 1, with or without a gradient for a given row.

    ``grads`` is ``(param, row, col, grad)``. A row without gradient keeps its value and
    moments, and is not decayed either.
    """
    theta, grad = "theta", "grad"
    if hp.decay and hp.decay[0] == "l2":
        grad = f"(grad + {_double(hp.decay[1])} * theta)"
    if hp.decay and hp.decay[0] == "decoupled":
        theta = f"theta * {_double(1.0 - hp.lr * hp.decay[1])}"
    m = f"({_double(hp.beta_1)} * m + {_double(1.0 - hp.beta_1)} * {grad})"
    v = f"({_double(hp.beta_2)} * v + {_double(1.0 - hp.beta_2)} * {grad} * {grad})"
    new = {"m": m, "v": v}
    scale = v
    if hp.amsgrad:
        scale = new["vmax"] = f"greatest(vmax, {v})"
    m_hat = f"{m} / {_double(1.0 - hp.beta_1**t)}"
    v_hat = f"{scale} / {_double(1.0 - hp.beta_2**t)}"
    moved = f"{theta} - {m_hat} * {_double(hp.lr)} / (sqrt({v_hat}) + {_double(hp.eps)})"
    updates = {"theta": moved, **new}
    return state.join(grads, KEY, "left").selectExpr(
        *KEY, *[f"CASE WHEN grad IS NULL THEN {old} ELSE {value} END AS {old}" for old, value in updates.items()]
    )


def _double(value: float) -> str:
    return f"{float(value)!r}D"
