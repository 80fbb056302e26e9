"""The layered model: cleaned tables, metrics, the wide fact, and the jobs that build them."""
