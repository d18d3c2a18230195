"""The catalogue models and the jobs that build and check them."""
