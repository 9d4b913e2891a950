"""Batch analytics on Spark for payments, marketing, enrollment and stock.

Landed JSON documents become typed, day-partitioned raw tables; staging models
cast and rename them; marts join and aggregate them.  Everything is a
DataFrame: Spark plans, partitions and shuffles the work.
"""
