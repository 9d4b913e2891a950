"""Staging models, marts, the model registry and the jobs that build them."""
