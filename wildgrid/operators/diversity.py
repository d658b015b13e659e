"""Diversity statistics of a presence-absence matrix: distinct (site, species) pairs.

alpha: species of a site; omega: sites of a species; S, N: numbers of species, sites.
What can be said by alpha and omega alone is; pairs of species (or sites) are counted
tile by tile (``tiles``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tiles


def presence(cells: DataFrame, least: int = 1) -> DataFrame:
    return cells.where(F.col("value") >= least).select(F.col("row").alias("site"), F.col("col").alias("species"))


def checked(pam: DataFrame, value: str = "value") -> DataFrame:
    """Pairs of a 0/1 matrix; other values are an error."""
    return pam.where(F.when(F.col(value).isin(0, 1), F.col(value) == 1).otherwise(F.raise_error(F.lit("values must be 0 or 1")).cast("boolean"))).select("site", "species")


def alpha(pam: DataFrame) -> DataFrame:
    return pam.groupBy("site").agg(F.count("*").alias("alpha"))


def omega(pam: DataFrame) -> DataFrame:
    return pam.groupBy("species").agg(F.count("*").alias("omega"))


def sizes(pam: DataFrame) -> DataFrame:
    return pam.agg(F.countDistinct("species").alias("S"), F.countDistinct("site").alias("N"))


def site_stats(pam: DataFrame) -> DataFrame:
    """(site, alpha, alpha_proportional, beta, phi, phi_average_proportional)."""
    phi = pam.join(omega(pam), "species").groupBy("site").agg(F.count("*").alias("alpha"), F.sum("omega").alias("phi"))
    j = phi.crossJoin(F.broadcast(sizes(pam)))
    return j.select("site", "alpha", (F.col("alpha") / F.col("S")).alias("alpha_proportional"), (F.col("S") / F.col("alpha")).alias("beta"), "phi", (F.col("phi") / (F.col("N") * F.col("alpha"))).alias("phi_average_proportional"))


def species_stats(pam: DataFrame) -> DataFrame:
    """(species, omega, omega_proportional, psi, psi_average_proportional)."""
    psi = pam.join(alpha(pam), "site").groupBy("species").agg(F.count("*").alias("omega"), F.sum("alpha").alias("psi"))
    j = psi.crossJoin(F.broadcast(sizes(pam)))
    return j.select("species", "omega", (F.col("omega") / F.col("N")).alias("omega_proportional"), "psi", (F.col("psi") / (F.col("S") * F.col("omega"))).alias("psi_average_proportional"))


def diversity_stats(pam: DataFrame) -> DataFrame:
    """One row: S, N, whittaker, lande, legendre, schluter_species, schluter_sites; from the marginals alone."""
    o = omega(pam).agg(F.count("*").alias("S"), F.sum("omega").alias("so"), F.sum(F.col("omega") * F.col("omega")).alias("soo"))
    a = alpha(pam).agg(F.count("*").alias("N"), F.sum("alpha").alias("sa"), F.sum(F.col("alpha") * F.col("alpha")).alias("saa"))
    j = o.crossJoin(F.broadcast(a))
    S, N, so, soo, sa, saa = (F.col(c).cast("double") for c in ("S", "N", "so", "soo", "sa", "saa"))
    return j.select(
        "S", "N", F.try_divide(S, so / N).alias("whittaker"), (S - so / N).alias("lande"), (so - soo / N).alias("legendre"),
        F.try_divide(saa / N - F.pow(so / N, 2), so / N - soo / (N * N)).alias("schluter_species"),
        F.try_divide(soo / S - F.pow(sa / S, 2), sa / S - saa / (S * S)).alias("schluter_sites"),
    )


def shared(pam: DataFrame, of: str = "species") -> DataFrame:
    """(i, j, n), i < j: sites that two species share (or species that two sites share), pairs with none left out."""
    return tiles.shared(pam, of)


def c_score(pam: DataFrame) -> DataFrame:
    """Mean checkerboard score over pairs of species. Pairs that share nothing add omega_i * omega_j, which the marginals give."""
    part = tiles.overlap_sums(pam).agg(F.coalesce(F.sum("squares") - F.sum("weighted"), F.lit(0)).alias("part"))
    m = omega(pam).agg(F.count("*").alias("S"), F.sum("omega").alias("so"), F.sum(F.col("omega") * F.col("omega")).alias("soo"))
    j = m.crossJoin(F.broadcast(part))  # one row
    all_ = (F.col("so") * F.col("so") - F.col("soo")) / 2 + F.col("part")
    return j.select(F.try_divide(2 * all_, F.col("S") * (F.col("S") - 1)).alias("c_score"))


def sigma(pam: DataFrame, of: str = "species") -> DataFrame:
    """(i, j, sigma), i <= j, of pairs that share something: covariance of species (or of sites).

    For pairs that share nothing it is -p_i * p_j; ``covariance_matrix`` has these too.
    """
    marginal, size, name = (omega, "N", "omega") if of == "species" else (alpha, "S", "alpha")
    m = marginal(pam)
    own = m.select(F.col(of).alias("i"), F.col(of).alias("j"), F.col(name).alias("both"))
    found = shared(pam, of).withColumnRenamed("n", "both").unionByName(own)
    j = found.join(m.select(F.col(of).alias("i"), F.col(name).alias("mi")), "i").join(m.select(F.col(of).alias("j"), F.col(name).alias("mj")), "j").crossJoin(F.broadcast(sizes(pam)))
    total = F.col(size)
    return j.select("i", "j", (F.col("both") / total - (F.col("mi") / total) * (F.col("mj") / total)).alias("sigma"))


def covariance_matrix(pam: DataFrame, of: str = "species") -> DataFrame:
    """(i, j, sigma), i <= j, of all S(S+1)/2 pairs of species (or of sites), zero overlaps included."""
    return tiles.covariances(pam, of)
