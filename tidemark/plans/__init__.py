"""The models: staging, intermediate, marts, snapshot and their checks."""
