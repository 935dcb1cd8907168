"""Scans: containers, image folders and artifacts."""
