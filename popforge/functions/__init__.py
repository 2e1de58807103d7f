"""Part of popforge."""
