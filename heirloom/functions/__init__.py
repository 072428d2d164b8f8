"""Part of heirloom; see the README for the operator map."""
