"""Four-vector arithmetic as Column expressions: everything stays in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the muon mass (GeV) that published dimuon analyses use.
MUON_MASS = 0.10565836727619171


def polar_angle(eta: Column) -> Column:
    return 2.0 * F.atan(F.exp(-eta))


def four_momentum(particle: Column, mass: float = MUON_MASS, pt: str = "pt_", eta: str = "eta_", phi: str = "phi_") -> dict[str, Column]:
    """px, py, pz, e of a struct with transverse momentum, pseudorapidity and azimuth; the momentum's sign is no matter."""
    size = F.abs(particle[pt])
    px, py = size * F.cos(particle[phi]), size * F.sin(particle[phi])
    pz = size / F.tan(polar_angle(particle[eta]))
    return {"px": px, "py": py, "pz": pz, "e": F.sqrt(px * px + py * py + pz * pz + mass**2)}


def invariant_mass(*particles: Column, mass: float = MUON_MASS) -> Column:
    """Of the sum of the particles' four-momenta. Rounding below zero, as of collinear pairs, counts as zero."""
    parts = [four_momentum(p, mass) for p in particles]
    total = {k: sum((p[k] for p in parts[1:]), parts[0][k]) for k in parts[0]}
    square = total["e"] * total["e"] - total["px"] * total["px"] - total["py"] * total["py"] - total["pz"] * total["pz"]
    return F.sqrt(F.greatest(square, F.lit(0.0)))


def delta_phi(a: Column, b: Column) -> Column:
    """Difference of two azimuths, within half a turn."""
    import math

    turn = 2 * math.pi
    return F.pmod(a - b + math.pi, F.lit(turn)) - math.pi


def delta_r(a: Column, b: Column) -> Column:
    d = delta_phi(a["phi_"], b["phi_"])
    return F.sqrt((a["eta_"] - b["eta_"]) * (a["eta_"] - b["eta_"]) + d * d)
