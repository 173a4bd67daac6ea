"""citeloom.functions"""
