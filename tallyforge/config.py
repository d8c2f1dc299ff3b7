"""Settings of a ranking run."""

from __future__ import annotations

from dataclasses import dataclass, fields


@dataclass(frozen=True)
class RankingConfig:
    mu: float = 0.5
    z_penalty: float = 1.2
    alpha: float = 0.72
    auto_gamma: bool = False
    gamma: float = 0.30
    gamma_min: float = 0.10
    gamma_max: float = 0.60
    gamma_base: float = 0.10
    gamma_slope: float = 1.5
    gap_policy: str = "encounter"
    k_min: float = 0.10
    k_bounds: tuple[float, float] = (0.05, 50.0)
    k_multiples: tuple[float, ...] = (0.25, 0.5, 1.0, 2.0, 4.0)
    k_expansions: int = 2
    rho_test: float = 1 / 3
    boot_n: int = 50
    boot_multiples: tuple[float, ...] = (2**-0.5, 1.0, 2**0.5)
    seed: int = 42
    rel_tol: float = 1e-3
    n_min_bt: float = 5.0
    bt_power: float | None = None
    bt_near_band: float = 0.10
    bt_harmonic: bool = True
    bt_ridge: float = 1.5
    bt_max_iter: int = 500
    bt_tol: float = 1e-6
    eps: float = 1e-12
    max_missing_ratio: float = 0.15
    min_missing: int = 1
    missing_ceil: bool = False
    share_threshold: float = 80.0
    #: A fixed prior strength; None chooses it by cross-validation.
    fixed_k: float | None = None

    @classmethod
    def of(cls, settings: dict) -> RankingConfig:
        unknown = set(settings) - {f.name for f in fields(cls)}
        if unknown:
            raise TypeError(f"unknown settings: {sorted(unknown)}")
        return cls(**settings)
