"""Cluster naming: every namer turns clusters into ``cluster_id, tag`` tables."""
