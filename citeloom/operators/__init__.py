"""citeloom.operators"""
