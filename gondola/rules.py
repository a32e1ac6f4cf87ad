"""Ordered substring rules for seasonality, margins and widths.

Rules are constants of the model, so operators turn them into one CASE
expression per row: no join, nothing to broadcast, and "first rule wins" is
the order of the WHEN branches.
"""

from __future__ import annotations

from typing import NamedTuple

# --- fixed values: seasonal demand, monthly data generation ------------------
SEASONAL_GENERATION = {
    1: {"fruta": 0.8, "verdura": 0.9, "chocolate": 1.3, "galleta": 1.1,
        "conserva": 1.1, "default": 0.95},
    2: {"fruta": 0.8, "verdura": 0.9, "chocolate": 1.5, "galleta": 1.1,
        "default": 0.95},
    3: {"fruta": 0.9, "verdura": 1.0, "cerveza": 1.1, "default": 1.0},
    4: {"fruta": 1.0, "verdura": 1.1, "cerveza": 1.1, "helado": 1.1,
        "default": 1.0},
    5: {"fruta": 1.1, "verdura": 1.1, "cerveza": 1.2, "helado": 1.3,
        "agua": 1.2, "refres": 1.2, "default": 1.0},
    6: {"fruta": 1.3, "verdura": 1.2, "helado": 1.5, "agua": 1.4,
        "refres": 1.4, "cerveza": 1.4, "default": 1.0},
    7: {"fruta": 1.4, "verdura": 1.3, "helado": 1.8, "agua": 1.6,
        "refres": 1.5, "cerveza": 1.5, "default": 1.0},
    8: {"fruta": 1.5, "verdura": 1.3, "helado": 1.9, "agua": 1.7,
        "refres": 1.6, "cerveza": 1.6, "default": 0.95},
    9: {"fruta": 1.1, "verdura": 1.1, "cereal": 1.2, "galleta": 1.1,
        "leche": 1.1, "default": 1.05},
    10: {"fruta": 0.9, "verdura": 1.0, "chocolate": 1.2, "galleta": 1.2,
         "conserva": 1.1, "default": 1.0},
    11: {"chocolate": 1.4, "galleta": 1.3, "vino": 1.2, "licor": 1.3,
         "conserva": 1.2, "turrón": 1.8, "default": 1.05},
    12: {"chocolate": 1.8, "galleta": 1.5, "vino": 1.6, "licor": 1.8,
         "marisco": 1.9, "turrón": 2.5, "jamón": 1.5, "embutido": 1.4,
         "carne": 1.3, "default": 1.15},
}

# --- fixed values: seasonal demand, forecast without replies -----------------
SEASONAL_FORECAST = {
    1: {"fruta": 0.8, "verdura": 0.9, "chocolate": 1.3, "default": 0.95},
    2: {"fruta": 0.8, "chocolate": 1.5, "default": 0.95},
    3: {"fruta": 0.9, "verdura": 1.0, "default": 1.0},
    4: {"fruta": 1.0, "verdura": 1.1, "default": 1.0},
    5: {"fruta": 1.1, "verdura": 1.1, "default": 1.0},
    6: {"fruta": 1.3, "verdura": 1.2, "helado": 1.5, "default": 1.0},
    7: {"fruta": 1.4, "verdura": 1.3, "helado": 1.8, "agua": 1.5,
        "default": 1.0},
    8: {"fruta": 1.5, "verdura": 1.3, "helado": 1.9, "agua": 1.6,
        "default": 0.95},
    9: {"fruta": 1.1, "cereal": 1.2, "default": 1.05},
    10: {"fruta": 0.9, "chocolate": 1.2, "default": 1.0},
    11: {"chocolate": 1.4, "vino": 1.2, "turrón": 1.8, "default": 1.05},
    12: {"chocolate": 1.8, "marisco": 1.9, "turrón": 2.5, "jamón": 1.5,
         "vino": 1.6, "default": 1.15},
}


class Band(NamedTuple):
    """Margin (%) and width (cm) ranges for categories matching any pattern."""

    patterns: tuple[str, ...]
    margin: tuple[float, float]
    width: tuple[float, float]


# --- fixed values: margin / width bands, monthly data generation -------------
BANDS_GENERATION = (
    Band(("fruta", "verdura", "lechuga"), (25, 45), (8, 25)),
    Band(("pescado", "marisco", "salaz"), (20, 40), (10, 30)),
    Band(("cerdo", "pollo", "vacuno", "cordero", "ave", "carne",
          "hamburguesa"), (15, 35), (12, 28)),
    Band(("chocolate", "galleta", "cereal", "turrón", "bollería"),
         (30, 55), (5, 20)),
    Band(("leche", "yogur", "queso", "mantequilla"), (20, 40), (6, 18)),
    Band(("cerveza", "vino", "licor", "agua", "refres", "zumo"),
         (25, 50), (6, 12)),
    Band(("higiene", "cuidado", "gel", "champu", "desodorante", "jabón"),
         (35, 60), (4, 10)),
    Band(("perfume", "colonia", "maquillaje", "labio", "ojo"),
         (40, 70), (3, 8)),
    Band(("conserva", "atún", "aceite", "vinagre"), (25, 45), (5, 15)),
    Band(("pasta", "arroz", "legumbre", "harina"), (20, 40), (6, 15)),
    Band(("congelad", "hielo"), (25, 45), (8, 22)),
    Band(("pan", "pico", "tostada"), (30, 50), (8, 20)),
    Band(("jamón", "embutido", "bacón", "chopped", "mortadela"),
         (25, 45), (8, 18)),
    Band((), (20, 50), (5, 20)),
)

# --- fixed values: margin / width bands, simple enrichment -------------------
BANDS_SIMPLE = (
    Band(("fruta", "verdura", "lechuga"), (25, 45), (8, 25)),
    Band(("pescado", "marisco", "salaz"), (20, 40), (10, 30)),
    Band(("cerdo", "pollo", "vacuno", "cordero", "ave"), (15, 35), (12, 28)),
    Band(("chocolate", "galleta", "cereal"), (30, 55), (5, 20)),
    Band(("leche", "yogur", "queso"), (20, 40), (6, 18)),
    Band(("cerveza", "vino", "licor", "agua", "refres"), (25, 50), (6, 12)),
    Band(("higiene", "cuidado", "gel", "champu", "desodorante"),
         (35, 60), (4, 10)),
    Band(("perfume", "colonia", "maquillaje", "labio", "ojo"),
         (40, 70), (3, 8)),
    Band((), (20, 50), (5, 20)),
)
