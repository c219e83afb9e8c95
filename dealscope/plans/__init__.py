"""Views, dashboard datasets and sync jobs composed from the operators."""
