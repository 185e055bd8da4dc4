"""Registered queries: one per SURVEY §2 inventory key (``registry.QUERIES``),
each with its DuckDB oracle SQL when the result is SQL-expressible
(``registry.ORACLES``).  Modules: q_history (WN), q_etl (sources, scalars,
ETL joins and aggregates), q_prep (index, splits, cleaning), q_eda (EDA,
top-k, sets), q_eval (metrics, scoring), q_ml (k-NN, resampling,
transforms), q_features (formulas), q_models (MLlib), q_stream (streaming),
q_more (remaining keys)."""
