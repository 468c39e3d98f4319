"""Compositions of operators.

validation    merge + checks + split + one-row summary
silver_job    the daily bronze -> silver job (also a command-line entry)
run_metrics   run / failure documents, stage metrics
"""
