"""
``DataFrame -> DataFrame`` function built from Spark SQL primitives.

filters (B), joins (C), aggregates (D), windows (E), ordering (F),
setops (G), encoding (I), sequences (D4, E4, J1-J3, J6), sampling (J4, J5,
J8), indexing (K2, E6, skew-safe ranks), batching (K), metrics (L, F3),
scoring (M1-M5), models (M6, M7).
"""
