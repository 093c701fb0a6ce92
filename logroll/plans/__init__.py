"""Registered plans (one per operator of the inventory) and their SQL oracle text."""
